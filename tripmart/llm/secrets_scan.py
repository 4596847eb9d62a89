"""Secrets in texts: fixed patterns, and values that would be hard to guess.

The base patterns are those of the contract. Beyond them, every value that stands where a
credential belongs is judged by the guesses it would take, whether or not a pattern covers it:
it is cut into words, dates, repeats, keyboard walks, sequences and spans of brute force, by
dynamic programming over its characters, such that the guesses multiply to the smallest
number. Values of ``10 ** LEAST_GUESSES`` guesses or more are secrets, with a span of their own.
What only refers to a value is none: variables, templates, calls, paths, and addresses that
hold no password.

Words and their ranks come from the vocabulary of a public tokenizer, whose order follows
frequency; its file is a parameter.

A repeat has a unit of ``LONGEST_UNIT`` characters at most. A longer one is judged as if it
stood twice, which decides nothing unless it takes between half and all of the digits of
``LEAST_GUESSES``, and a unit that long hardly does.

Defined results: no text is empty; repeated rows get a result each. Spans are in code
points, their ends excluded. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import rows_in_arrow

# Fixed values of the contract: kinds in order, patterns, least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
LEAST_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

# Where a credential belongs, and the value there: quoted, or up to white space.
NAMES = (
    "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "credential",
    "api_key", "api-key", "apikey", "access_key", "access-key", "accesskey", "private_key",
    "private-key", "privatekey", "bearer",
)
# Of a header, the scheme stands before the value, with or without a name before it.
CONTEXT = re.compile(
    rf"(?:(?:{'|'.join(NAMES)})s?(?:[\"']?[ \t]*(?::=|=>|[:=])[ \t]*|[ \t]+(?=[\"']))"
    r"(?:bearer[ \t]+)?|bearer[ \t]+)"
    r"""(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"'<>,;]+))""",
    re.ASCII | re.IGNORECASE,
)
_TRAILING = ".!?)]}"

# What stands for a value: a variable, a template, a call, a look-up, a path, a blank, or an
# address without a password in it.
REFERENCE = re.compile(
    r"""\$\w+|\$?\{.*\}|\$\(.*\)|\[.*\]|%\w+%|%\(\w+\)s|%s|<.*>|\*+|x+|\.+|-+|none|null|nil|undefined"""
    r"""|true|false|[a-z_][\w.]*\(.*\)|(?:os\.environ|process\.env|env|self|this|config|settings"""
    r"""|args|options|params|request|secrets|vars?)[.\[(].*|(?:~|\.{1,2})?/[\w./-]*"""
    r"""|[a-z][a-z0-9+.-]*://(?![^/\s]*:[^/\s]*@).*""",
    re.ASCII | re.IGNORECASE,
)

# Parameters of the guessing.
LEAST_GUESSES = 8  # decimal digits
BRUTE_FORCE = 10  # guesses per character
SEGMENT = math.log10(2)  # what every further segment costs
WORDS_FILE = "byte_bpe_50k.json"
LEAST_WORD = 3
LONGEST_UNIT = 64  # of a repeat
LEAST_WALK = 3

# Fixed value: keys side by side and above one another.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('!@#$%^&*()_+{}:"<>?', "1234567890-=[];',./", strict=True))
LEET = str.maketrans("40312$5@7", "aoeizssat")

_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_values", pa.int64()),
        ("guesses", pa.string()),
    ]
)
_FOUND_DDL = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_values long, guesses string"
)

Span = tuple[int, str, int]  # start, kind, end
Value = tuple[int, int, float]  # start, end, decimal digits of the guesses


# -- Guesses ------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def word_ranks(path: str) -> dict[str, int]:
    """Rank of each word of a byte-level vocabulary, in lower case."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks: dict[str, int] = {}
    for token, _ in sorted(vocabulary.items(), key=lambda x: x[1]):
        word = token.removeprefix("Ġ").lower()  # the letter that stands for a space
        if word.isascii() and word.isalpha() and len(word) >= LEAST_WORD:
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


_PLACE = {k: (row, column) for row, keys in enumerate(KEYBOARD) for column, k in enumerate(keys)}


def _neighbours() -> dict[str, str]:
    """Keys next to each key; a row stands half a key to the right of the one above."""
    near: dict[str, set[str]] = {}
    for key, (row, column) in _PLACE.items():
        for other, (r, c) in _PLACE.items():
            if (r, c) in (
                (row, column - 1), (row, column + 1), (row - 1, column), (row - 1, column + 1),
                (row + 1, column), (row + 1, column - 1),
            ):
                near.setdefault(key, set()).add(other)
    return {key: "".join(sorted(others)) for key, others in near.items()}


NEIGHBOURS = _neighbours()
_DEGREE = sum(map(len, NEIGHBOURS.values())) / len(NEIGHBOURS)


def _case_guesses(word: str) -> float:
    upper = sum(c.isupper() for c in word)
    if not upper:
        return 0.0
    if upper == len(word) or (upper == 1 and word[0].isupper()):
        return math.log10(2)
    choices = range(1, min(upper, len(word) - upper) + 1)
    return math.log10(sum(math.comb(len(word), n) for n in choices))


def word_matches(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """Words in a value, as they are, with digits for letters, or backwards."""
    plain = value.lower()
    if len(plain) != len(value):
        return
    leet = plain.translate(LEET)
    longest = max(map(len, ranks), default=0)
    for start in range(len(value) - LEAST_WORD + 1):
        for end in range(start + LEAST_WORD, min(len(value), start + longest) + 1):
            part = plain[start:end]
            case = _case_guesses(value[start:end])
            if rank := ranks.get(part):
                yield start, end, math.log10(rank) + case
            if rank := ranks.get(part[::-1]):
                yield start, end, math.log10(2 * rank) + case
            changed = leet[start:end]
            if changed != part and (rank := ranks.get(changed)):
                swaps = sum(a != b for a, b in zip(part, changed, strict=True))
                yield start, end, math.log10(rank * 2**swaps) + case


_DATE = re.compile(
    r"(?=((?:\d{1,2}([-/._ ])\d{1,2}\2(?:\d{4}|\d{2}))|(?:\d{4}([-/._ ])\d{1,2}\3\d{1,2})))",
    re.ASCII,
)
_PLAIN_DATE = re.compile(r"(?=((?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])))", re.ASCII)
_YEAR = re.compile(r"(?=((?:19|20)\d{2}))", re.ASCII)
_DAYS = math.log10(365 * 120)


def date_matches(value: str) -> Iterator[tuple[int, int, float]]:
    for m in _DATE.finditer(value):
        yield m.start(1), m.end(1), _DAYS + math.log10(4)
    for m in _PLAIN_DATE.finditer(value):
        yield m.start(1), m.end(1), _DAYS
    for m in _YEAR.finditer(value):
        yield m.start(1), m.end(1), math.log10(120)


def walk_matches(value: str) -> Iterator[tuple[int, int, float]]:
    """Runs of neighbouring keys; every turn multiplies the guesses."""
    keys = "".join(SHIFTED.get(c, c) for c in value.lower())
    if len(keys) != len(value):
        return
    start = 0
    for at in range(1, len(keys) + 1):
        if at < len(keys) and keys[at] in NEIGHBOURS.get(keys[at - 1], ""):
            continue
        if at - start >= LEAST_WALK:
            run = keys[start:at]
            ways = _directions(run)
            turns = 1 + sum(a != b for a, b in zip(ways, ways[1:]))
            shifts = sum(a != b for a, b in zip(value[start:at], run, strict=True))
            guesses = math.log10(len(NEIGHBOURS) * len(run)) + turns * math.log10(_DEGREE)
            yield start, at, guesses + shifts * math.log10(2)
        start = at


def _directions(run: str) -> list[tuple[int, int]]:
    """The step from each key to the next."""
    places = [_PLACE[key] for key in run]
    return [(r - row, c - column) for (row, column), (r, c) in zip(places, places[1:])]


def sequence_matches(value: str) -> Iterator[tuple[int, int, float]]:
    """Runs of characters that follow each other, up or down."""
    start = 0
    for at in range(1, len(value) + 1):
        step = ord(value[at]) - ord(value[at - 1]) if at < len(value) else 0
        first = ord(value[start + 1]) - ord(value[start]) if start + 1 < len(value) else 0
        if step in (1, -1) and step == first and value[at].isalnum():
            continue
        if at - start >= LEAST_WALK:
            yield start, at, math.log10(26 * (at - start))
        start = at - 1 if at < len(value) and at - start >= 2 and step in (1, -1) else at


def repeat_matches(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """Units of up to ``LONGEST_UNIT`` characters twice or more in a row."""
    for unit in range(1, min(LONGEST_UNIT, len(value) // 2) + 1):
        start = 0
        while start + 2 * unit <= len(value):
            end = start + unit
            while end < len(value) and value[end] == value[end - unit]:
                end += 1
            times = (end - start) // unit
            if times >= 2 and times * unit >= LEAST_WALK:
                once = _unit_guesses(value[start : start + unit], ranks)
                yield start, start + times * unit, once + math.log10(times)
                start = start + (times - 1) * unit + 1
            else:
                start += 1


def _unit_guesses(unit: str, ranks: dict[str, int]) -> float:
    return min_guesses(unit, ranks) if len(unit) > 1 else math.log10(BRUTE_FORCE)


def all_matches(value: str, ranks: dict[str, int]) -> list[tuple[int, int, float]]:
    return [
        *word_matches(value, ranks),
        *date_matches(value),
        *walk_matches(value),
        *sequence_matches(value),
        *repeat_matches(value, ranks),
    ]


def min_guesses(value: str, ranks: dict[str, int]) -> float:
    """Decimal logarithm of the guesses for a value, by its cheapest segmentation.

    Two costs per place: with a match ending there, and with a span of brute force, which
    may go on without being another segment.
    """
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, guesses in all_matches(value, ranks):
        ending.setdefault(end, []).append((start, guesses))
    brute = math.log10(BRUTE_FORCE)
    # The first segment costs no separator.
    best, forced = [-SEGMENT], [math.inf]
    for end in range(1, len(value) + 1):
        forced.append(min(forced[-1] + brute, best[end - 1] + SEGMENT + brute))
        match = min(
            (best[start] + SEGMENT + guesses for start, guesses in ending.get(end, ())),
            default=math.inf,
        )
        best.append(min(match, forced[end]))
    return max(best[-1], 0.0)


# -- Spans ----------------------------------------------------------------------------------

_BASE_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    folded = text.lower()
    if any(name in folded for name in _BASE_NAMES):
        found += [
            (m.start(), "assign", m.end())
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= LEAST_VALUE
        ]
    # A run that is too short has no longer one inside it.
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def credential_values(text: str, ranks: dict[str, int]) -> list[Value]:
    """Every value in a credential's place that is no reference, with its guesses."""
    folded = text.lower()
    if not any(name in folded for name in NAMES):
        return []
    found = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        value = text[start:end]
        if REFERENCE.fullmatch(value):
            continue
        if m.lastindex == 3:
            value = value.rstrip(_TRAILING)
        if len(value) >= LEAST_VALUE and not REFERENCE.fullmatch(value):
            found.append((start, start + len(value), min_guesses(value, ranks)))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_text(
    text: str | None, ranks: dict[str, int]
) -> tuple[list[Span], list[Span], list[Value]]:
    """Base spans, all spans in order, and all values with their guesses."""
    text = text or ""
    base, values = base_spans(text), credential_values(text, ranks)
    more = [(start, "guess", end) for start, end, digits in values if digits >= LEAST_GUESSES]
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1]), s[2])), values


def scan(documents: DataFrame, words: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, the number
    of credential values (n_values), and for each of them start:end:digits (guesses), where
    the digits are those of the number of guesses, with two decimals.

    ``words`` is the file of the vocabulary, at the same place on every executor.
    """
    if words is None:
        import public_tokenizers

        words = public_tokenizers.path(WORDS_FILE)

    def found(rows: Iterator[dict]) -> Iterator[tuple]:
        ranks = word_ranks(words)
        for row in rows:
            base, spans, values = scan_text(row["text"], ranks)
            kinds = [kind for _, kind, _ in base]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            guesses = ",".join(f"{start}:{end}:{digits:.2f}" for start, end, digits in values)
            yield (
                row["doc_id"], *map(kinds.count, KINDS[:3]), digest, written(spans), len(values),
                guesses,
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(rows_in_arrow(found, _FOUND), _FOUND_DDL)
