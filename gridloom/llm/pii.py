"""Personal data with offset-preserving deobfuscation.

The base kinds are plain patterns over the text as it stands. A transducer then
rewrites disguises into the characters they stand for (homoglyphs and wide
forms, invisible characters, spelled digits, ``[at]`` and ``(dot)``), keeping
for every output character the source characters it came from. The same
patterns run over the rewritten text, and a match that used at least one
rewritten character is mapped back to its span in the source. Base spans always
stay; a disguised span inside a base span of its kind adds nothing.

Numbers with a spelled digit are read in several ways, and the check of each
kind decides. In an address, dots and dot words part the numbers; a full stop
before a space does so only where a part has three digits, so a spoken count is
none. In cards and phones, spaces, dots, hyphens, brackets, commas and one line
break at a time may part the digits. A longer match takes the place of the
shorter ones inside it, but a single digit after a comma or line break never
lengthens a number that is complete without it.

Every search takes time in proportion to the length of the text, however long its
runs of letters, digits or separators are: addresses are sought from their ``@``
outwards, runs are entered at their start only, and the parts of a disguised
address have the lengths that mail allows (64 and 63 characters).

Defined results: a null text is empty and has no spans; offsets count code
points of the original text, end exclusive; matches that fail their check are
dropped and not tried again; repeated rows give repeated results; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bound_batches

KINDS = ("email", "ip", "card", "phone")

# Patterns of the kinds. An address is the letters before an @ and what _DOMAIN takes from it on; a run of
# digits is entered at its start, as no later start goes on differently.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: A text without this cannot hold the kind.
NEEDS = {"email": re.compile("@"), "ip": re.compile(r"[0-9]\.[0-9]"),
         "card": re.compile(r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": re.compile(r"\+[0-9]")}
_DIGIT = re.compile("[0-9]")

# Letters that look like ASCII, spelled digits and disguised signs.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "−": "-", " ": " ", " ": " ", " ": " ", "﹫": "@",
}
INVISIBLE = "­​‌‍⁠﻿"
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
           "six": "6", "seven": "7", "eight": "8", "nine": "9"}
#: Wide forms and other digit sets follow from code point ranges.
_SINGLE = {ord(k): v for k, v in HOMOGLYPHS.items()}
_SINGLE |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
_SINGLE |= {base + d: str(d) for base in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
            for d in range(10)}

_ODD = "[" + "".join(re.escape(chr(c)) for c in _SINGLE) + "]"
_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
#: Spelled digits count only in runs of digits, so prose keeps its number words.
_DIGIT_RUN = re.compile(rf"(?<![A-Za-z0-9])(?:(?:{_WORDS}|[0-9]+)[\x20.-]+){{4,}}(?:{_WORDS}|[0-9]+)(?![A-Za-z0-9])", re.I)
_SPELLED_PLUS = re.compile(rf"(?<![A-Za-z0-9])plus[\x20-]+(?=(?:{_WORDS}|[0-9])(?![A-Za-z]))", re.I)
_BRACKET_AT = re.compile(r"(?:(?<!\s)\s++)?[\[({<]\s*(?:at|@|ät)\s*[\])}>]\s*", re.I)
_BRACKET_DOT = re.compile(r"(?:(?<!\s)\s++)?[\[({<]\s*(?:dot|\.|punkt|point|punto)\s*[\])}>]\s*", re.I)
_LABEL = r"[A-Za-z0-9-]{1,63}"
_PART = r"[A-Za-z0-9._%+-]{1,64}"
_SPACED_DOT = r"[\x20_-]{1,4}dot[\x20_-]{1,4}"
#: Bare words need the whole shape: name at host dot label. A name is entered where its run begins.
_BARE = re.compile(rf"(?<![A-Za-z0-9._%+-])(?P<name>{_PART}(?:{_SPACED_DOT}{_PART}){{0,4}})(?P<at>[\x20_-]{{1,4}}at[\x20_-]{{1,4}}|@)"
                   rf"(?P<host>{_LABEL}(?:\.{_LABEL}){{0,8}}(?:{_SPACED_DOT}{_LABEL})+)", re.I)
_BARE_DOT = re.compile(r"[\x20_-]+dot[\x20_-]+", re.I)
_NUMBER_DOT = re.compile(r"(?<=[0-9])[\x20]+dot[\x20]+(?=[0-9])", re.I)
_DIGIT_WORD = re.compile(rf"(?:{_WORDS})", re.I)


class Rewritten:
    """A text and, for each character, the source span it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.lo = list(range(len(text)))
        self.hi = list(range(1, len(text) + 1))
        self.changed = [False] * len(text)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply ordered, disjoint edits (start, end, new characters)."""
        if not edits:
            return
        out, lo, hi, changed, at = [], [], [], [], 0
        for start, end, new in edits:
            out.append(self.text[at:start])
            lo += self.lo[at:start]
            hi += self.hi[at:start]
            changed += self.changed[at:start]
            out.append(new)
            lo += [self.lo[start]] * len(new)
            hi += [self.hi[end - 1]] * len(new)
            changed += [True] * len(new)
            if not new and changed:
                changed[-1] = True
            at = end
        out.append(self.text[at:])
        self.text = "".join(out)
        self.lo, self.hi = lo + self.lo[at:], hi + self.hi[at:]
        self.changed = changed + self.changed[at:]

    def sub(self, pattern: re.Pattern, new) -> None:
        self.replace([(m.start(), m.end(), new(m) if callable(new) else new) for m in pattern.finditer(self.text)])


_HIDDEN = re.compile(f"[{INVISIBLE}]")
_ODD_RE = re.compile(_ODD)
_DIGIT_PART = re.compile(rf"(?:{_WORDS})|[0-9]+", re.I)
_SPELLED_WORD = re.compile(rf"(?<![A-Za-z])(?:{_WORDS})+(?![A-Za-z])", re.I)
_DOT_WORD = re.compile(r"(?<![A-Za-z])dot(?![A-Za-z])", re.I)


def _disguised(text: str) -> bool:
    """Whether the text holds anything the transducer rewrites; cheap for plain prose."""
    if not text.isascii() and (_ODD_RE.search(text) or _HIDDEN.search(text)):
        return True
    if any(b in text for b in "[({<") and (_BRACKET_AT.search(text) or _BRACKET_DOT.search(text)):
        return True
    lower = text.lower()
    if "dot" in lower and _DOT_WORD.search(text):
        return True
    return any(w in lower for w in SPELLED) and bool(_SPELLED_WORD.search(text))


def _digit_runs(text: str) -> list[tuple[int, int, str]]:
    """Edits that turn runs with spelled digits into bare digits, separators included."""
    edits = []
    for run in _DIGIT_RUN.finditer(text):
        if not _DIGIT_WORD.search(run[0]):
            continue
        parts = list(_DIGIT_PART.finditer(run[0]))
        for i, part in enumerate(parts):
            end = parts[i + 1].start() if i + 1 < len(parts) else part.end()
            edits.append((run.start() + part.start(), run.start() + end, SPELLED.get(part[0].lower(), part[0])))
    return edits


def _dots(m: re.Match, part: str) -> list[tuple[int, int, str]]:
    return [(m.start(part) + d.start(), m.start(part) + d.end(), ".") for d in _BARE_DOT.finditer(m[part])]


def _signs(text: str) -> Rewritten:
    """The text with plain characters, signs and dots; number words and bare words stay."""
    out = Rewritten(text)
    out.sub(_HIDDEN, "")
    out.sub(_ODD_RE, lambda m: _SINGLE[ord(m[0])])
    out.sub(_BRACKET_AT, "@")
    out.sub(_BRACKET_DOT, ".")
    return out


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises, or None when it has none."""
    if not _disguised(text):
        return None
    out = _signs(text)
    if _digit_runs(out.text):
        out.sub(_SPELLED_PLUS, "+")
        out.replace(_digit_runs(out.text))
    out.sub(_NUMBER_DOT, ".")
    edits = []
    for m in _BARE.finditer(out.text):
        edits += _dots(m, "name")
        if m["at"] != "@":
            edits.append((m.start("at"), m.end("at"), "@"))
        edits += _dots(m, "host")
    out.replace(edits)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def _addresses(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of an address, each found from its @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(done, at + 1))
    return out


def matches(text: str, kind: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches that pass the check of their kind."""
    if (kind != "email" and not _DIGIT.search(text)) or not NEEDS[kind].search(text):
        return []
    if kind == "email":
        return _addresses(text)
    return [m.span() for m in PATTERNS[kind].finditer(text) if _passes(kind, m[0])]


_GAP = r"[\s().,_-]{0,8}"
_ATOM = rf"(?:(?<![A-Za-z])(?:{_WORDS})++(?![A-Za-z])|(?<![0-9])[0-9]++)"
_PLUS_WORD = r"(?<![A-Za-z])plus(?![A-Za-z])"
#: Digits and spelled digits in a row, with the separators that any number kind may have.
_STRETCH = re.compile(rf"(?:(?:\+|{_PLUS_WORD}){_GAP})?{_ATOM}(?:{_GAP}(?:(?<![A-Za-z])dot(?![A-Za-z]){_GAP})?{_ATOM})+", re.I)
_TOKEN = re.compile(rf"(?P<plus>\+|plus)|(?P<digit>{_WORDS}|[0-9])|(?P<gap>(?:dot|[\s().,_-])+)", re.I)
_IP_DOT = re.compile(r"[\x20_-]*dot[\x20_-]*|[\x20]+\.[\x20]*|\.", re.I)
_FULL_STOP = re.compile(r"\.[\x20]+")
_JOINED = re.compile(r"[\x20_-]+")
_TIGHT = re.compile(r"[\x20.-]+")
#: Stands for a gap that ends a number.
_END = "|"


class Gap:
    """Separators between two digits: whether those are spelled, and the digits up to the next comma or line break."""

    __slots__ = ("text", "left", "right", "ahead")

    def __init__(self, text: str, left: bool):
        self.text, self.left, self.right, self.ahead = text, left, False, 0

    @property
    def lines(self) -> int:
        return self.text.count("\n")

    @property
    def breaks(self) -> bool:
        return "," in self.text or "\n" in self.text


def _ip_gap(gap: Gap, either: bool, stops: bool) -> str:
    if _IP_DOT.fullmatch(gap.text) or (stops and _FULL_STOP.fullmatch(gap.text)):
        return "."
    joined = gap.left or gap.right if either else gap.left and gap.right
    return "" if joined and _JOINED.fullmatch(gap.text) else _END


def _long_part(found: str) -> bool:
    return any(len(part) == 3 for part in found.split("."))


#: Readings of a stretch, from strict to loose: kinds, what a gap becomes, further check,
#: and whether a match may replace shorter ones.
_READINGS = (
    (("ip",), lambda g: _ip_gap(g, False, False), None, True),
    (("ip",), lambda g: _ip_gap(g, True, False), None, True),
    (("ip",), lambda g: _ip_gap(g, True, True), _long_part, True),
    (("card", "phone"), lambda g: "" if _TIGHT.fullmatch(g.text) else _END, None, True),
    (("card", "phone"), lambda g: "" if not g.lines and (g.ahead > 1 or not g.breaks) else _END, None, True),
    (("card", "phone"), lambda g: "" if g.lines < 2 and (g.ahead > 1 or not g.breaks) else _END, None, True),
    (("card", "phone"), lambda g: "" if g.lines < 2 else _END, None, False),
)


def _tokens(stretch: str) -> list[tuple[str | Gap, int, int, bool]]:
    """Sign, digits and gaps with their places in the stretch, and whether a digit is spelled."""
    out: list[tuple[str | Gap, int, int, bool]] = []
    for m in _TOKEN.finditer(stretch):
        if m["plus"]:
            out.append(("+", m.start(), m.end(), False))
        elif m["digit"]:
            out.append((SPELLED.get(m[0].lower(), m[0]), m.start(), m.end(), not m[0].isdigit()))
        elif out[-1][0] != "+":
            out.append((Gap(m[0], out[-1][3]), m.start(), m.end(), False))
    ahead, right = 0, False
    for token, _, _, spelled in reversed(out):
        if isinstance(token, Gap):
            token.right, token.ahead = right, ahead
            ahead = 0 if token.breaks else ahead
        else:
            ahead, right = ahead + 1, spelled
    return out


def _spelled_numbers(clear: Rewritten, base: dict[str, Spans], every: dict[str, Spans]) -> None:
    """Add the numbers that use a spelled digit to the spans of their kinds."""
    for stretch in _STRETCH.finditer(clear.text):
        if not _DIGIT_WORD.search(stretch[0]):
            continue
        tokens = _tokens(stretch[0])
        for kinds, becomes, check, replaces in _READINGS:
            text, place = [], []
            for token, start, end, spelled in tokens:
                new = becomes(token) if isinstance(token, Gap) else token
                if new:
                    text.append(new)
                    place.append((start, end, spelled))
            whole = "".join(text)
            for kind in kinds:
                for a, b in matches(whole, kind):
                    if not any(p[2] for p in place[a:b]) or (check and not check(whole[a:b])):
                        continue
                    span = (clear.lo[stretch.start() + place[a][0]], clear.hi[stretch.start() + place[b - 1][1] - 1])
                    _add(span, base[kind], every[kind], replaces)


class Spans:
    """Spans in order, none inside another, so that their ends are in order too."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [s for s, _ in spans], [e for _, e in spans]

    def hold(self, span: tuple[int, int]) -> bool:
        """Whether the span lies in one of these."""
        k = bisect_right(self.starts, span[0])
        return k > 0 and self.ends[k - 1] >= span[1]

    def touch(self, span: tuple[int, int]) -> bool:
        """Whether the span shares a character with one of these."""
        k = bisect_right(self.ends, span[0])
        return k < len(self.starts) and self.starts[k] < span[1]

    def take_in(self, span: tuple[int, int]) -> None:
        """Put the span in the place of those inside it."""
        lo, hi = bisect_left(self.starts, span[0]), bisect_right(self.ends, span[1])
        self.starts[lo:max(lo, hi)], self.ends[lo:max(lo, hi)] = [span[0]], [span[1]]

    def listed(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))


def _add(span: tuple[int, int], base: Spans, extra: Spans, replaces: bool) -> None:
    """Add a span that is in no other one; it takes the place of the disguised spans inside it."""
    if base.hold(span) or extra.hold(span) or (not replaces and (base.touch(span) or extra.touch(span))):
        return
    extra.take_in(span)


def spans(text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans and all spans of each kind, in order."""
    base = {kind: matches(text, kind) for kind in KINDS}
    clear = rewrite(text)
    if clear is None:
        return base, base
    plain, extra = {}, {}
    for kind in KINDS:
        plain[kind] = Spans(base[kind])
        used = [(clear.lo[a], clear.hi[b - 1]) for a, b in matches(clear.text, kind) if any(clear.changed[a:b])]
        extra[kind] = Spans([span for span in used if not plain[kind].hold(span)])
    if _SPELLED_WORD.search(text) or not text.isascii():
        _spelled_numbers(_signs(text), plain, extra)
    return base, {kind: sorted(base[kind] + extra[kind].listed()) for kind in KINDS}


def listing(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in found[kind])


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_batch(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, every = spans(text or "")
        rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(listing(base).encode()).hexdigest(), listing(every)))
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def found(text: Column) -> Column:
    return F.pandas_udf(find_batch, RESULT)(text)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document with counts of base spans, their digest and all spans; no shuffle."""
    return bound_batches(docs).select("doc_id", found(F.col("text")).alias("p")).select("doc_id", "p.*")


def redact(docs: DataFrame, mask: str = "[{kind}]") -> DataFrame:
    """The documents with every span, plain or disguised, replaced by its kind."""
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact_text(t, mask))

    return bound_batches(docs).withColumn("text", F.pandas_udf(run, "string")(F.col("text")))


def redact_text(text: str, mask: str = "[{kind}]") -> str:
    _, every = spans(text)
    ordered = sorted((s, e, kind) for kind in KINDS for s, e in every[kind])
    out, at = [], 0
    for start, end, kind in ordered:
        if start >= at:
            out += [text[at:start], mask.format(kind=kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])
