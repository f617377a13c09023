"""A small labelled table of personal data written as the base patterns don't
know it, and of what only looks like it.

The rows are made by rule from a seed, so the table is a function of its
parameters: a random field learns from it which shapes are personal data. Forms
per kind:

* email: the at sign or the dots as words, bracketed or bare, or spaced;
* ip: dots bracketed, spaced or as words, one of them or all;
* card: groups joined by other signs, or 14 and 15 digits in their own groups;
* phone: no plus sign, with brackets, dots, dashes, spaces, 00 or 011 first.

Look-alikes are dates, times, versions, book numbers, prices, ranges, lists of
numbers, rooms, part numbers, and ``at`` and ``dot`` in running text. A card
number with a wrong check digit has the shape of a right one: it is told apart
by the digit, not by the field, so it is no row here.
"""

from __future__ import annotations

import random

KINDS = ("email", "ip", "card", "phone")
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnprstvwz"
SUFFIXES = ("com", "org", "net", "io", "edu", "info", "co.uk", "de")


def _word(r: random.Random, most: int = 12) -> str:
    n = r.randint(2, most)
    w = "".join(r.choice(CONSONANTS if (i + n) % 2 else VOWELS) for i in range(n))
    return w if r.random() < 0.8 else w.capitalize() if r.random() < 0.8 else w.upper()


def _number(r: random.Random, digits: int) -> str:
    return str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(digits - 1))


def check_digit(digits: str) -> str:
    """The last digit that makes ``digits`` and it pass Luhn's test."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 if i % 2 else 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _grouped(digits: str, sizes: tuple[int, ...], sign: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(digits[at:at + n])
        at += n
    return sign.join(out)


def email(r: random.Random) -> str:
    local = r.choice([_word(r), f"{_word(r)}.{_word(r)}", f"{_word(r, 6)}{r.randint(1, 99)}", f"{_word(r)}_{_word(r, 5)}"])
    host = _word(r) if r.random() < 0.8 else f"{_word(r, 6)}-{_word(r, 6)}"
    labels = [host, *([_word(r, 6)] if r.random() < 0.2 else []), *r.choice(SUFFIXES).split(".")]
    dots = ["[dot]", "(dot)", " [dot] ", " (dot) ", " dot ", " DOT ", "[.]"]
    at = r.choice(["[at]", "(at)", " [at] ", " (at) ", " [AT] ", " at ", " at ", " AT ", "@", " @ "])
    if "[" in at or "(" in at:
        dots += [".", "."]
    elif "@" not in at:
        dots += [" dot "] * 4  # a bare "at" comes mostly with bare dots
    return local + at + r.choice(dots).join(labels)


def ip(r: random.Random) -> str:
    parts = [str(r.choice([r.randint(0, 255), r.randint(0, 9), 10, 192, 168, 172])) for _ in range(4)]
    sign = r.choice(["[.]", "(.)", "[dot]", "(dot)", " dot ", " [dot] ", " . ", " [.] "])
    if sign.startswith(("[", "(")) and r.random() < 0.3:
        odd = r.randrange(3)
        return parts[0] + "".join((sign if i == odd else ".") + p for i, p in enumerate(parts[1:]))
    return sign.join(parts)


def card(r: random.Random) -> str:
    if r.random() < 0.25:
        head, sizes = r.choice([("34", (4, 6, 5)), ("37", (4, 6, 5)), ("36", (4, 6, 4)), ("38", (4, 6, 4))])
        signs = [" ", "-", ".", "/"]
    else:
        head, sizes, signs = r.choice("3456"), r.choice([(4, 4, 4, 4)] * 4 + [(4, 4, 4, 4, 3)]), [".", "/", "_", "  ", " - ", ". "]
    body = head + "".join(str(r.randint(0, 9)) for _ in range(sum(sizes) - len(head) - 1))
    return _grouped(body + check_digit(body), sizes, r.choice(signs))


def phone(r: random.Random) -> str:
    a, e, n = _number(r, 3), _number(r, 3), _number(r, 4)
    sign = r.choice([" ", "-", ".", "-"])
    return r.choice([
        f"({a}) {e}-{n}", f"({a}) {e}-{n}", f"({a}){e}-{n}", f"({a}) {e} {n}", sign.join((a, e, n)), sign.join((a, e, n)),
        sign.join(("1", a, e, n)), f"1 ({a}) {e}-{n}", sign.join(("001", a, e, n)), f"001 ({a}) {e}-{n}",
        sign.join(("00" + _number(r, 2), _number(r, 2), _number(r, 4), n)), sign.join(("011", _number(r, 2), _number(r, 2), n, n)),
        f"0{a} {_number(r, 6)}", f"0{a}-{_number(r, 7)}", f"(0{_number(r, 2)}) {n} {_number(r, 4)}"])


MAKERS = {"email": email, "ip": ip, "card": card, "phone": phone}


def look_alike(r: random.Random) -> str:
    y, m, d, h = r.randint(1950, 2030), r.randint(1, 12), r.randint(1, 28), r.randint(0, 23)
    two = lambda: f"{r.randint(0, 99):02d}"
    return r.choice([
        lambda: f"{y}-{m:02d}-{d:02d}", lambda: f"{d:02d}/{m:02d}/{y}", lambda: f"{d:02d}.{m:02d}.{y}",
        lambda: f"{m:02d}-{d:02d} {h:02d}:{two()}", lambda: f"{y}-{m:02d}-{d:02d} {h:02d}:{two()}:{two()}",
        lambda: f"{h:02d}:{two()}:{two()}", lambda: "-".join(two() for _ in range(4)), lambda: " ".join(two() for _ in range(5)),
        lambda: f"v{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}", lambda: f"{r.randint(0, 20)}.{r.randint(0, 30)}.{r.randint(0, 9)}-{r.randint(1, 9)}",
        lambda: f"97{r.choice('89')}-{r.randint(0, 9)}-{_number(r, 2)}-{_number(r, 6)}-{r.randint(0, 9)}", lambda: f"97{r.choice('89')}{_number(r, 10)}",
        lambda: f"{r.randint(0, 9)}-{_number(r, 3)}-{_number(r, 5)}-{r.randint(0, 9)}", lambda: f"{_number(r, 2)},{_number(r, 3)}.{two()}",
        lambda: f"${_number(r, 2)}.{two()}", lambda: f"{y}-{y + r.randint(1, 9)}", lambda: f"{_number(r, 3)}-{_number(r, 3)}",
        lambda: " ".join(_number(r, r.randint(1, 3)) for _ in range(r.randint(3, 7))), lambda: ", ".join(_number(r, r.randint(2, 4)) for _ in range(4)),
        lambda: _number(r, r.choice([8, 9, 10, 12, 13])), lambda: f"{_number(r, 1)}-{_number(r, 3)}{_word(r, 2)}",
        lambda: f"{_word(r, 2).upper()}-{_number(r, 4)}-{_number(r, 3)}", lambda: f"{_number(r, 3)}-{_number(r, 4)}-{two()}",
        lambda: f"0.{two()} 0.{two()} 0.{two()}",
        lambda: f"{r.randint(1, 9)} . {two()}", lambda: f"{y} {y + 1} {y + 2}", lambda: f"{_number(r, 3)}%", lambda: f"#{_number(r, 6)}",
        lambda: f"{_word(r)} at {_word(r)}", lambda: f"{_word(r)} at {_word(r)}.com", lambda: f"{_word(r)} at {h}:{two()}",
        lambda: f"the dot {_word(r)}", lambda: f"a dot at {_word(r)}", lambda: f"{_word(r)} dot {_word(r)}",
        lambda: f"{_word(r)} [at {_word(r)}]", lambda: f"@{_word(r)}", lambda: f"{_word(r)} (dot) {_word(r)}", lambda: f"{r.randint(1, 9)} dot {two()}",
    ])()


def sentences(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``n`` rows of text and its labelled spans ``(kind, start, end)``: three
    fifths hold one or two variants, all may hold look-alikes."""
    r, out = random.Random(seed), []
    for k in range(n):
        made = [(kind, MAKERS[kind](r)) for kind in r.choices(KINDS, k=r.choice([1, 1, 1, 2]))] if k % 5 < 3 else []
        made += [(None, look_alike(r)) for _ in range(r.choice([0, 0, 1]) if made else r.choice([1, 2]))]
        r.shuffle(made)
        text, spans = "", []
        for kind, value in made:
            text += "".join(_word(r) + r.choice([" "] * 6 + [", ", ". ", ": ", " - "]) for _ in range(r.randint(0, 6)))
            if kind:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + r.choice([" "] * 5 + [", ", ". ", "; "])
        text += " ".join(_word(r) for _ in range(r.randint(0, 5)))
        out.append((text, spans))
    return out
