"""Invented prose."""

import random

WORDS = "the of and in to a is was river stone cloud paper lamp green quick brown fox over lazy dog".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))
