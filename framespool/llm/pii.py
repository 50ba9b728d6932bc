"""Personal data: plain detectors, and the same detectors behind offset-preserving deobfuscation.

Base detectors run on the text as it is. Then transducers rewrite disguised spellings, each output character keeping
the source span it came from: homoglyphs to ASCII, runs of spelled digits to digits, at/dot disguises to @ and '.'.
The detectors run again on the normalised text, and what they find is mapped back to source offsets. A found span is
added if it lies over no base span of its kind; base spans always stay.

Offsets are code points, the end exclusive. Cases: null text is empty and has no spans; a row gives one row, repeated
or not; a null doc_id stays null; an empty table gives an empty result; other columns are ignored. All scans are
linear in the text, however long a run of digits, dots or letters is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from .common import keyed, map_rows, sha256, table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Characters of the contract's patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT_RUN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Look-alike letters of other scripts, and the spelled digits.
HOMOGLYPHS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "а": "a", "е": "e",
    "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ο": "o", "ν": "v", "ι": "i",
    "ı": "i", "ɡ": "g", "ℓ": "l", "․": ".", "。": ".", "•": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@",
    "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}
SPELLED = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def _glyphs() -> dict[int, str]:
    """HOMOGLYPHS, full-width ASCII and the digits of the mathematical alphabets and of circled forms, one to one."""
    out = {ord(k): v for k, v in HOMOGLYPHS.items()}
    out |= {c + 0xFEE0: chr(c) for c in range(0x21, 0x7F)}
    out |= {0x1D7CE + k: str(k % 10) for k in range(50)}
    out |= {0x2460 + k: str(k + 1) for k in range(9)}
    return out | {start + k: str(k) for start in (0x0660, 0x06F0, 0x0966) for k in range(10)}


GLYPHS = _glyphs()
GLYPH = re.compile("[" + "".join(re.escape(chr(c)) for c in GLYPHS) + "]")
_WORD = "(?:" + "|".join(SPELLED) + "|oh)"
#: Three or more spelled digits in a row; digits may stand between them.
SPELLED_RUN = re.compile(rf"\b(?:plus[ \t]+)?{_WORD}(?:[ \t,-]{{1,3}}(?:{_WORD}|[0-9]+)){{2,}}\b", re.I)
SPELLED_PART = re.compile(rf"plus|{_WORD}|[0-9]+", re.I)
_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_AT_BOX, _DOT_BOX = rf"(?:{_OPEN}(?:at|@){_CLOSE})", rf"(?:{_OPEN}(?:dot|punto|punkt|point|\.){_CLOSE})"
_AT_WORD, _DOT_WORD = r"(?:[ \t]+at[ \t]+|[ \t]*@[ \t]*)", r"(?:[ \t]+(?:dot|punto|punkt|point)[ \t]+|_dot_|-dot-)"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_USER = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{1,64}(?:(?:\.|" + _DOT_BOX + "|" + _DOT_WORD + r")[A-Za-z0-9_%+-]{1,64}){0,4}"
#: A boxed at may go with plain dots; an at as a word (or a plain @) needs a disguised dot.
MAIL = re.compile(
    rf"{_USER}(?:{_AT_BOX}{_LABEL}(?:(?:\.|{_DOT_BOX}|{_DOT_WORD}){_LABEL}){{1,6}}|{_AT_WORD}(?:{_LABEL}\.){{0,4}}{_LABEL}(?:{_DOT_BOX}|{_DOT_WORD}){_LABEL}(?:(?:\.|{_DOT_BOX}|{_DOT_WORD}){_LABEL}){{0,5}})",
    re.I,
)
MAIL_PART = re.compile(rf"({_AT_BOX}|[ \t]+at[ \t]+|[ \t]*@[ \t]*)|({_DOT_BOX}|{_DOT_WORD})", re.I)
IP_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT_BOX}|{_DOT_WORD})(?=[0-9])", re.I)
#: Four groups of one to three digits, each spelled or not, with spelled, boxed or plain dots between them.
_GROUP = rf"(?:{_WORD}|[0-9]{{1,3}})(?:[ \t-]{{1,3}}(?:{_WORD}|[0-9])){{0,2}}"
SPELLED_IP = re.compile(rf"(?<![\w.])(?:{_GROUP})(?:(?:{_DOT_BOX}|{_DOT_WORD}|\.)(?:{_GROUP})){{3}}(?![\w]|\.[\w])", re.I)
IP_PART = re.compile(rf"{_WORD}|[0-9]+|dot|punto|punkt|point|\.", re.I)
HINT = re.compile(r"[\[({<][ \t]*(?:at|@|dot|punto|punkt|point|\.)[ \t]*[\])}>]|[ \t_-](?:dot|punto|punkt|point)[ \t_-]", re.I)


def emails(text: str) -> Iterator[Span]:
    """Every match of the contract's pattern, found from each @ outwards."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            yield start, last
        else:
            last = at + 1
        at = text.find("@", last)


def ips(text: str) -> Iterator[Span]:
    for m in DIGIT_RUN.finditer(text):
        parts, start = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):  # a match takes four parts, right or wrong
            size = sum(map(len, parts[k : k + 4])) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in parts[k : k + 4]):
                yield start, start + size
            start += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.span()


FIND = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


class Rewritten:
    """A text after rewriting, with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.cuts: list[tuple[int, int, int, int]] = []  # (start, end, source start, source end) of rewritten pieces

    def apply(self, changes: list[tuple[int, int, str]]) -> None:
        """Replaces [start, end) by a string, for changes in order that don't overlap."""
        if not changes:
            return
        parts, cuts, at, size = [], [], 0, 0
        for start, end, new in changes:
            parts += [self.text[at:start], new]
            size += start - at
            cuts.append((size, size + len(new), *self.source(start, end)))
            size += len(new)
            at = end
        moved, shift, k = [], 0, 0
        for cut in self.cuts:  # earlier pieces that no change touches move with the text around them
            while k < len(changes) and changes[k][1] <= cut[0]:
                shift += len(changes[k][2]) - (changes[k][1] - changes[k][0])
                k += 1
            if k == len(changes) or changes[k][0] >= cut[1]:
                moved.append((cut[0] + shift, cut[1] + shift, *cut[2:]))
        parts.append(self.text[at:])
        self.text, self.cuts = "".join(parts), sorted(cuts + moved)

    def source(self, start: int, end: int) -> Span:
        """Source span of [start, end)."""
        return self._place(start, 0), self._place(end - 1, 1)

    def _place(self, at: int, side: int) -> int:
        import bisect

        k = bisect.bisect_right(self.cuts, (at, float("inf"))) - 1
        if k < 0:
            return at + side
        a, b, source, source_end = self.cuts[k]
        if at < b:
            return source_end if side else source
        return source_end + (at - b) + side


def _digits(m: re.Match) -> str:
    names = {w: str(k) for k, w in enumerate(SPELLED)} | {"oh": "0", "plus": "+"}
    return "".join(names.get(x.lower(), x) for x in SPELLED_PART.findall(m[0]))


def _address(m: re.Match) -> str:
    """Digits and dots of a SPELLED_IP."""
    names = {w: str(k) for k, w in enumerate(SPELLED)} | {"oh": "0"}
    return "".join(names.get(x.lower(), x if x.isdigit() else ".") for x in IP_PART.findall(m[0]))


def deobfuscate(text: str) -> Rewritten | None:
    """The text with disguises undone, or None where there is nothing to undo."""
    out = Rewritten(text.translate(GLYPHS) if GLYPH.search(text) else text)
    changed = out.text != text
    if HINT.search(out.text):
        changes = [(*m.span(), _address(m)) for m in SPELLED_IP.finditer(out.text)]
        out.apply(changes)
        changed |= bool(changes)
    changes = [(*m.span(), _digits(m)) for m in SPELLED_RUN.finditer(out.text)]
    out.apply(changes)
    changed |= bool(changes)
    if HINT.search(out.text):
        for _ in range(2):
            changes = [(*m.span(), ".") for m in IP_DOT.finditer(out.text)]
            out.apply(changes)
            changed |= bool(changes)
        changes = [
            (m.start() + p.start(), m.start() + p.end(), "@" if p[1] else ".") for m in MAIL.finditer(out.text) for p in MAIL_PART.finditer(m[0])
        ]
        out.apply(changes)
        changed |= bool(changes)
    return out if changed else None


def find_personal(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans by kind, in order."""
    base = {k: list(f(text)) for k, f in FIND.items()}
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    clear = deobfuscate(text)
    if clear:
        for kind, find in FIND.items():
            found = sorted({clear.source(*s) for s in find(clear.text)})
            k = 0
            for start, end in found:
                while k < len(base[kind]) and base[kind][k][1] <= start:
                    k += 1
                if k == len(base[kind]) or base[kind][k][0] >= end:
                    added[kind].append((start, end))
    return base, added


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, base), in the order of KINDS and of start; one row per row."""

    def rows(row: dict) -> list[tuple]:
        base, added = find_personal(row["text"])
        spans = [(k, s, e, b) for k in KINDS for s, e, b in sorted([(*x, True) for x in base[k]] + [(*x, False) for x in added[k]])]
        return [(row["doc_id"], [dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in spans])]

    return map_rows(
        keyed(docs).select("doc_id", "text"), f"doc_id {_id(docs)}, spans array<struct<kind:string,start:int,end:int,base:boolean>>", rows
    )


def _id(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base_sha256 are those of the base spans, spans holds all."""
    from pyspark.sql import functions as F

    spans = personal_spans(table(spark, sf_dir, "documents"))
    text = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long")
    return spans.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans"),
        F.size(F.filter("spans", lambda x: ~x["base"])).cast("long").alias("n_added"),
    )


QUERIES = {"op3_personal_data": op3_personal_data}
SQL: dict[str, str] = {}
