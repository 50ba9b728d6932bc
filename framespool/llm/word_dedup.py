"""Substring dedup on words: remove every word inside a repeated run of `length` words, by level-wise doubling.

Candidates are windows around content-defined anchors (repeats.py). The first level, 9 words at the anchors, runs over all
documents, and only repeated ones are extended to the second, 18 words to the left and right; of those that repeat again
the whole context is judged, at once where it occurs twice. Where contexts differ, windows are named level by level: two
neighbouring names of one length give the name at twice that length, and a window whose name occurs once goes no
further, until `length` is reached or no candidate survives. Those names are exact: they number distinct pairs.

Cases: null and empty texts have no words. Each row is a document, repeated rows too (so their words repeat); fewer
words than `length` lose none. A null doc_id stays null. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, table
from .repeats import Shape, Tokens, covered, cut_spans

LENGTH, GRAM = 35, 9
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Powers of _BASE and of its inverse, as far as some text has needed them.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[k] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def words_of(data: bytes) -> Tokens:
    """The words joined by one space, and where each starts and ends."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = (raw == 0x20) | (raw - np.uint8(9) < 5)
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = turn[::2], turn[1::2]
    if len(starts) and (starts[0] or ends[-1] < len(raw) or (starts[1:] - ends[:-1] > 1).any() or (raw[ends[:-1]] != 0x20).any()):
        data = b" ".join(data.split())  # bytes.split() splits at the same six characters
        sizes = ends - starts
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        ends = starts + sizes
    return data, starts, ends


def word_grams(tokens: Tokens, first: int, last: int, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of the grams that start at words [first, last). Good enough to choose by; equality is not theirs."""
    data, starts, ends = tokens
    a, b = int(starts[first]), int(ends[last + gram - 2])
    raw = np.frombuffer(data, np.uint8)[a:b].astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        power, inverse = _powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(raw * power[:-1], out=total[1:])
        s, e = starts[first : last + gram - 1] - a, ends[first : last + gram - 1] - a
        word = (total[e] - total[s]) * inverse[s]
        word = (word ^ (word >> np.uint64(29))) * _MIX
        n = last - first
        out = np.zeros(n, np.uint64)
        for k in range(gram):
            out = out * _BASE + word[k : k + n]
        out = (out ^ (out >> np.uint64(32))) * _MIX
        return (out >> np.uint64(32)).astype(np.uint32)


def double_up(data: list[bytes], before: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Most words to the left and right of the anchor that repeated windows of each context cover."""
    words = [d.split(b" ") for d in data]
    width = shape.left + shape.right
    ids: dict[bytes, int] = {}
    names = np.full((len(words), width), -1, np.int64)
    for k, (row, b) in enumerate(zip(words, before)):
        at = shape.left - b
        names[k, at : at + len(row)] = [ids.setdefault(w, len(ids)) for w in row]
    size = 1
    while True:
        names = _repeated(names)
        if size == shape.length:
            break
        step = min(size, shape.length - size)
        first, second = names[:, : names.shape[1] - step], names[:, step:]
        both = (first >= 0) & (second >= 0)
        names = np.where(both, first * (names.max() + 2) + second, -1)
        size += step
        if not both.any():
            return np.zeros(len(data), int), np.zeros(len(data), int)
    # column j: the window starts at j, that is shape.left - j words before the anchor
    hit = names[:, : shape.span] >= 0
    any_ = hit.any(axis=1)
    left = np.where(any_, shape.left - hit.argmax(axis=1), 0)
    right = np.where(any_, hit.shape[1] - 1 - hit[:, ::-1].argmax(axis=1) + shape.length - shape.left, 0)
    return left, right


def _repeated(names: np.ndarray) -> np.ndarray:
    """Numbers the names of each column anew; those that occur once in their column become -1."""
    at = np.nonzero(names >= 0)
    if not len(at[0]):
        return names
    key = names[at] * names.shape[1] + at[1]
    _, new, n = np.unique(key, return_inverse=True, return_counts=True)
    out = np.full(names.shape, -1, np.int64)
    out[at] = np.where(n[new] > 1, new, -1)
    return out


def remove_repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, text (words that stay, joined by one space), n_words, n_removed."""
    docs, shape = keyed(docs), Shape(length, gram, length - gram + 1, 0, doubling=length >= 3 * gram - 1)
    spans = covered(docs, words_of, lambda t, a, b: word_grams(t, a, b, gram), shape, double_up)

    def cut(tokens: Tokens, gone: np.ndarray) -> tuple:
        kept = b" ".join([w for w, g in zip(tokens[0].split(b" "), gone.tolist()) if not g])
        return kept, len(gone), int(gone.sum())

    def whole(data: bytes) -> tuple:
        words = data.split()
        return b" ".join(words), len(words), 0

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint"
    return cut_spans(docs, spans, words_of, cut, whole, schema)


def op4_word_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op4_word_dedup": op4_word_dedup}
SQL = {
    "op4_word_dedup": f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS words FROM documents),
w AS (SELECT r, unnest(range(1, len(words) - {LENGTH - 2})) AS a, words FROM d WHERE len(words) >= {LENGTH}),
h AS (SELECT r, a, md5(array_to_string(words[a:a + {LENGTH - 1}], ' ')) AS h FROM w),
g AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT r, unnest(range(a, a + {LENGTH})) AS pos FROM h SEMI JOIN g USING (h)),
p AS (SELECT r, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM d),
k AS (SELECT p.r, p.pos, word, c.pos IS NULL AS keep FROM p LEFT JOIN c ON p.r = c.r AND p.pos = c.pos),
s AS (SELECT r, count(*) AS n, count(*) FILTER (NOT keep) AS gone, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (keep), '') AS kept FROM k GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s ON d.r = s.r"""
}
