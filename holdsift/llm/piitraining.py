"""Labelled examples for the personal-data model: real stretches of text with made-up data and look-alikes in them."""

from __future__ import annotations

import random
from collections.abc import Callable

_NAMES = "anna ben carlo dora emil fay gus hana ivan june kai lena milo nora otto pia quin rosa sam tess uwe vera will xena yan zoe".split()
_HOSTS = "mail post inbox example web corp uni lab shop net-co my-site".split()
_ENDS = "com org net de fr es io co.uk example.com edu info".split()
_PLAIN = "Write to me at the office or call when you can, the number is on the door and it is open from nine. "


def _luhn_digit(digits: str) -> str:
    total = sum(n if i % 2 else 2 * n - 9 * (n > 4) for i, n in enumerate(int(d) for d in reversed(digits)))
    return str(-total % 10)


def email(rng: random.Random) -> str:
    user = rng.choice(_NAMES) + rng.choice(["", ".", "_", "-"]) + rng.choice([rng.choice(_NAMES), str(rng.randrange(100)), ""])
    user = user.strip("._-")
    host, end = rng.choice(_HOSTS) + rng.choice(["", str(rng.randrange(10))]), rng.choice(_ENDS)
    at = rng.choice(["@", "@", " @ ", "(at)", " (at) ", "[at]", " [at] ", " at ", "{at}", " AT "])
    dot = rng.choice([".", "."]) if at == "@" else rng.choice([".", " . ", " dot ", "(dot)", " (dot) ", "[dot]", " [dot] ", "{dot}", " DOT "])
    if at.strip().lower() == "at":
        dot = rng.choice([" dot ", " (dot) ", " [dot] ", " DOT "])
    text = user + at + (host + "." + end).replace(".", dot)
    return text.upper() if rng.random() < 0.1 else text


def ip(rng: random.Random) -> str:
    dot = rng.choice([".", ".", "[.]", " . ", "(.)", " dot ", "[dot]", ". "])
    return dot.join(str(rng.randrange(256)) for _ in range(4))


def card(rng: random.Random) -> str:
    digits = rng.choice("3456") + "".join(str(rng.randrange(10)) for _ in range(rng.choice([12, 14, 14, 14, 14, 17])))
    digits += _luhn_digit(digits)
    gap = rng.choice(["", " ", "-", ".", "/", "_", "  ", " - ", "–"])
    return gap.join(digits[i: i + 4] for i in range(0, len(digits), 4))


def phone(rng: random.Random) -> str:
    d = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    area, mid, last, code = d(3), d(3), d(4), str(rng.randrange(1, 99))
    return rng.choice([f"+{code} ({area}) {mid}-{last}", f"+{code} {area} {mid} {last}", f"+{code}{area}{mid}{last}", f"+{code}-{area}-{mid}-{last}",
                       f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"00{code} {area} {mid} {last}",
                       f"+ {code} ({area}) {mid} {last}", f"{area}/{mid}{last}", f"+{code}/{area}/{mid}/{last}", f"({code}) {area} {mid} {last}"])


def lookalike(rng: random.Random) -> str:
    """Numbers and signs that are no personal data."""
    d = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    return rng.choice([f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"v{d(1)}.{d(1)}.{d(2)}", f"{d(1)}.{d(2)}", f"{d(2)},{d(3)}", f"{d(1)}%",
                       f"{rng.randrange(256, 999)}.{d(2)}.{d(1)}.{rng.randrange(300, 999)}", d(rng.choice([1, 2, 3, 4, 5, 6, 7])), f"{d(4)}/{d(4)}", f"@{rng.choice(_NAMES)}",
                       f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"', f"Version {d(1)}.0", f"page {d(3)}", f"#{d(5)}", f"{d(2)} x {d(3)}",
                       d(rng.choice([20, 24, 30])), "dot", "the dot on the map", "at noon (at) times", f"${d(3)}.{d(2)}", f"{d(1)}.{d(1)}.{d(1)}", f"id_{d(8)}x", f"{d(3)}-{d(2)}"])


_MAKERS = (email, ip, card, phone)


def examples(carriers: list[str], base_spans: Callable, n: int, length: int, seed: int) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """``n`` texts of ``length`` signs with their spans (kind, start, end). Data cut off at an end is not labelled."""
    rng = random.Random(seed)
    sources = [c for c in carriers if len(c) >= 40] or [_PLAIN]
    texts, labels = [], []
    while len(texts) < n:
        source = rng.choice(sources)
        begin = rng.randrange(max(1, len(source) - length // 2))
        text = source[begin: begin + length]
        spans = base_spans(text)
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            made, kind = (lookalike(rng), None) if rng.random() < 0.3 else (None, rng.randrange(4))
            made = made or _MAKERS[kind](rng)
            gaps = [i for i, c in enumerate(text) if c in " \n" and not any(a < i + 1 < b for _, a, b in spans)]
            at = rng.choice(gaps) + 1 if gaps else 0
            left, right = rng.choice(["", "", "", "(", ": ", "<", "tel ", "mail: ", "“"]), rng.choice([" ", " ", ", ", ". ", ") ", "### ", "! ", "\n"])
            put = left + made + right
            spans = [(k, a + len(put) * (a >= at), b + len(put) * (a >= at)) for k, a, b in spans]
            text = text[:at] + put + text[at:]
            if kind is not None:
                spans.append((kind, at + len(left), at + len(left) + len(made)))
        shift = rng.randrange(max(1, len(text) - length + 1))
        text = text[shift: shift + length].ljust(length)
        spans = [(k, a - shift, b - shift) for k, a, b in spans]
        texts.append(text)
        labels.append(sorted(s for s in spans if s[1] >= 0 and s[2] <= length))
    return texts, labels
