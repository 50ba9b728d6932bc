"""SentencePiece encoding and decoding through a table of distinct chunks.

In a vocabulary where no piece goes on past a white space marker, a text's segmentation is that of its marked words,
one after the other. A chunk is a run of markers with the word behind it; line feeds stand alone where no longer piece
holds one.

1. Every task counts the distinct chunks of its texts and hands on its KEEP most frequent; the sums of all tasks give the
   most frequent chunks of the corpus, TABLE at most (whole powers of two of their counts, so that ties stay together).
2. Spark segments each chunk of that table once, and the table, bounded by TABLE and LONG, goes to all tasks.
3. A text's chunks are looked up and their ids joined back by position. Chunks outside the table, which are rare, are
   segmented where they stand, and each worker remembers up to TABLE of them.

Which chunks the table holds decides only how often a chunk is segmented, never the ids. A table of all chunks would be
unbounded, and to join it back by position would shuffle the rare words of every text.

Where the vocabulary has pieces that cross markers, or the model normalises text, the library encodes whole texts.

Cases: null text is empty and has no ids; rows are encoded one by one, repeated or not; texts of any length and any
characters (bytes stand for what the vocabulary lacks) match the library's encode and decode. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batch, arrow_schema, discard, keyed, map_rows, sha256, stored, table

MARK = "▁"
#: Chunks of the table and, besides, of a worker's memory; characters of a chunk that may be in them; chunks that a task
#: hands on, and those that it counts before it does.
TABLE, LONG, KEEP, COUNTED = 200_000, 64, 50_000, 1_000_000
#: An entry: ids as text, their number, and what they decode to if that isn't the chunk.
Entry = tuple[str, int, str | None]


class Pieces:
    """Encodes and decodes with one model, chunk by chunk.

    A chunk is written as in the text: a word, or runs of spaces and a word, stand for their marker and it; one that
    begins with a line feed has no marker in front."""

    def __init__(self, model: str, known: dict[str, Entry] | None = None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        plain = all(self.model.decode(self.model.encode(t)) == t for t in ("  a  ", "\uff21 \ufb01", " \t\n "))
        crossing = any(re.search(f"[^{MARK}]{MARK}", x) for x in self.names) or any("\n" in x and len(x) > 1 for x in self.names)
        self.by_chunk = plain and not crossing
        self.byte = {k: int(x[3:5], 16) for k, x in enumerate(self.names) if self.model.is_byte(k)}
        self.table = known or {}
        self.known = dict(self.table)

    def _surface(self, ids: list[int]) -> str:
        """What the ids decode to inside a text, markers as markers."""
        out, raw = [], bytearray()
        for k in ids:
            if k in self.byte:
                raw.append(self.byte[k])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.names[k])
        return "".join([*out, raw.decode("utf-8", "replace")])

    def segmented(self, chunks: list[str]) -> dict[str, Entry]:
        """Segments chunks, all in one call."""
        out = {}
        for chunk, ids in zip(chunks, self.model.encode(chunks, num_threads=1), strict=True):
            if not chunk:
                ids = [self.model.piece_to_id(MARK)]
            elif chunk[0] == "\n":
                ids = ids[1:]
            surface = "".join([self.names[k] for k in ids])
            if "<0x" in surface:
                surface = self._surface(ids)
            surface = surface.replace(MARK, " ") if chunk[:1] == "\n" else surface[1:].replace(MARK, " ")
            out[chunk] = (",".join(map(str, ids)), len(ids), None if surface == chunk else surface)
        return out

    def _learn(self, chunks: list[str]) -> dict[str, Entry]:
        """Segments chunks and remembers them."""
        new = self.segmented(chunks)
        if len(self.known) + len(new) > len(self.table) + TABLE:
            self.known = dict(self.table)
        self.known.update((c, e) for c, e in new.items() if len(c) <= LONG)
        return new

    def _look(self, chunks: list[str]) -> list[Entry]:
        found = list(map(self.known.get, chunks))
        if None in found:
            new = self._learn(list({c for c, e in zip(chunks, found) if e is None}))
            found = [e or new[c] for c, e in zip(chunks, found)]
        return found

    @staticmethod
    def _chunks(text: str) -> list[str]:
        if MARK in text:
            text = text.replace(MARK, " ")
        words = text.replace("\n", " \n").split(" ")
        if "" not in words and text[0] != "\n" and " \n" not in text:
            return words
        # a chunk with its marker written as a space, except for the first marker, which the library adds
        return [c[1:] if c[:1] == " " else c for c in re.findall(r" +[^ \n]*|\n[^ \n]*", " " + text)]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not self.by_chunk:
            return self.model.encode(text)
        return [int(k) for e in self._look(self._chunks(text)) for k in e[0].split(",")]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and the decoded text."""
        if not text:
            return 0, "", ""
        if not self.by_chunk:
            ids = self.model.encode(text)
            return len(ids), ",".join(map(str, ids)), self.model.decode(ids)
        chunks = self._chunks(text)
        found = self._look(chunks)
        decoded = "".join([c if c[:1] == "\n" else " " + c for c in [c if e[2] is None else e[2] for c, e in zip(chunks, found)]])[1:]
        return sum([e[1] for e in found]), ",".join([e[0] for e in found]), decoded


def _on_worker(model: str, shared: Broadcast) -> Pieces:
    """The worker's own for one broadcast table; it outlives the task."""
    name, known = shared.value
    if _LOADED.get("name") != name:
        _LOADED.update(name=name, pieces=Pieces(model, known))
    return _LOADED["pieces"]


_LOADED: dict = {}


def chunk_counts(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """(chunk, n): the chunks that a task has most of, and how often. docs: (text). Runs of spaces count as one here."""
    schema = "chunk string, n bigint"
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    counts.update(text.replace("\n", " \n").split(" "))
                if len(counts) > COUNTED:
                    yield handed(counts)
                    counts = Counter()
        yield handed(counts)

    def handed(counts: Counter) -> pa.RecordBatch:
        chosen = [(c, n) for c, n in counts.most_common(keep) if c and len(c) <= LONG and MARK not in c]
        return arrow_batch(chosen, out_schema) if chosen else pa.RecordBatch.from_pylist([], schema=out_schema)

    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def chunk_table(docs: DataFrame, model: str, size: int = TABLE, keep: int = KEEP) -> dict[str, Entry]:
    """The most frequent chunks of docs (text), `size` at most, each segmented once, in Spark."""
    sums = stored(chunk_counts(docs, keep).groupBy("chunk").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n")).cast("int")
    least, room = 64, size
    for row in sorted(sums.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):  # 63 rows at most
        if row["n"] > room:
            break
        least, room = row["level"], room - row["n"]
    schema = "chunk string, ids string, n int, surface string"
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            pieces = pieces or Pieces(model)
            if batch.num_rows and pieces.by_chunk:
                yield arrow_batch([(c, *e) for c, e in pieces.segmented(batch.column(0).to_pylist()).items()], out_schema)

    rows = sums.filter(level >= least).select("chunk").mapInArrow(run, schema).collect()  # `size` at most
    discard(sums)
    return {x["chunk"]: (x["ids"], x["n"], x["surface"]) for x in rows}


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, chunk_table(docs, model)))

    def rows(row: dict) -> list[tuple]:
        pieces = _on_worker(model, shared)
        ids = pieces.encode(row["text"])
        return [(row["doc_id"], ids, pieces.digest(row["text"])[2])]

    return map_rows(keyed(docs).select("doc_id", "text"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string", rows, flush=500)


def encoded_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, without sending the ids themselves back."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, chunk_table(docs, model)))

    def rows(row: dict) -> list[tuple]:
        n, ids, decoded = _on_worker(model, shared).digest(row["text"])
        return [(row["doc_id"], n, hashlib.sha256(ids.encode()).hexdigest(), sha256(decoded))]

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(keyed(docs).select("doc_id", "text"), schema, rows)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), model_path())


QUERIES = {"op8_sentencepiece": op8_sentencepiece}
SQL: dict[str, str] = {}
