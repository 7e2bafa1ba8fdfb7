"""SentencePiece encoding and decoding through a table of distinct marked chunks.

The normaliser turns each space into the mark U+2581 and puts one mark before a text that is not empty.  In a vocabulary
whose pieces hold marks only as a leading run, no merge joins a character to the mark after it, so a text falls into chunks
(a run of marks and what follows it up to the next mark) that the library segments the same way alone as in place.

1. Chunks are counted over all texts, combined in the task before the shuffle.
2. The most frequent of those found twice or more, ``MOST_CHUNKS`` chunks of at most ``LONGEST`` characters, are segmented once each in
   a table of chunks and their ids (little-endian 32-bit words), which goes to every task.
3. The ids are joined back by position: a text's ids are its chunks' entries end to end.  A chunk found once in the corpus has
   one place only and is segmented there.  The other rare chunks are segmented at their places too, with the same ids; with
   ``join_rest`` they are segmented once each in a second table, joined to the texts' chunks, and come back by the text's
   digest, which moves several times the input.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from paralith.llm.common import positional, text_digest, written

MARK = "▁"
MOST_CHUNKS = 300_000
LONGEST = 256
MOST_COUNTED = 500_000
_chunk = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_encoders: dict[str, ChunkEncoder] = {}
_tables: dict[str, dict[str, bytes]] = {}


def chunks_of(text: str) -> list[str]:
    """The marked chunks of a text that is not empty, in order."""
    return _chunk.findall(MARK + text.replace(" ", MARK))


def model_path(model: str) -> str:
    """The file of a public tokenizer by its name, or ``model`` itself where it is a path."""
    if "/" in model:
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


class ChunkEncoder:
    """Ids of texts by one model, by their chunks."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.separable = all(MARK not in p.lstrip(MARK) for p in pieces) and self.model.encode("a  b ") == self.model.encode(f"a{MARK}{MARK}b{MARK}")
        self.mark = np.array([self.model.piece_to_id(MARK)], "<u4").tobytes()
        self.ends = tuple(np.array([i], "<u4").tobytes() for i in (self.model.bos_id(), self.model.eos_id()))

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, all of which begin with the mark that the library itself puts before a text."""
        return [self.mark if c == MARK else np.array(ids, "<u4").tobytes() for c, ids in zip(chunks, self.model.encode([c[1:] for c in chunks], num_threads=1), strict=True)]

    def encode(self, text: str, table: dict[str, bytes] | None = None, rest: dict[str, bytes] | None = None) -> bytes:
        """All ids of ``text`` with begin and end, as little-endian 32-bit words; chunks in neither table are segmented here."""
        if not text or not self.separable:
            return self.ends[0] + np.array(self.model.encode(text), "<u4").tobytes() + self.ends[1]
        chunks = chunks_of(text)
        found = table or {}
        try:
            body = b"".join(map(found.__getitem__, chunks))
        except KeyError:
            own = dict(rest or {})
            new = [c for c in dict.fromkeys(chunks) if c not in found and c not in own]
            own.update(zip(new, self.segment(new), strict=True))
            body = b"".join([found[c] if c in found else own[c] for c in chunks])
        return self.ends[0] + body + self.ends[1]


def encoder(model: str) -> ChunkEncoder:
    """This process's encoder of ``model``."""
    if model not in _encoders:
        _encoders[model] = ChunkEncoder(model)
    return _encoders[model]


def chunk_counts(texts: DataFrame) -> DataFrame:
    """chunk, n: the chunks found twice or more in the texts (column t).  Null and empty texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        pack = lambda: pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["chunk", "n"])
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    n.update(chunks_of(t))
                if len(n) > MOST_COUNTED:
                    yield pack()
                    n.clear()
        yield pack()

    return written(texts.select("t").mapInArrow(count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n")).where("n > 1"), "chunks")


def segmented(chunks: DataFrame, model: str) -> DataFrame:
    """chunk, ids of the rows of ``chunks``."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(e.segment(batch.column(0).to_pylist()), pa.binary())], names=["chunk", "ids"])

    return chunks.select("chunk").mapInArrow(segment, "chunk string, ids binary")


def _split_counts(counted: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent chunks of ``counted``, at most ``most`` of at most ``LONGEST`` characters, and the rest, if there is any.

    The cut is at a power of 2 to the quarter of the count, which is found from as many sums as there are such powers.
    """
    ranked = counted.withColumn("rank", F.when(F.length("chunk") <= LONGEST, F.floor(4 * F.log2("n"))).otherwise(-1))
    sums = {r["rank"]: r["count"] for r in ranked.groupBy("rank").count().collect()}  # 4 * 63 rows at most
    cut, had = max(sums, default=0) + 1, 0
    for rank in sorted((r for r in sums if r >= 0), reverse=True):
        if had + sums[rank] > most:
            break
        cut, had = rank, had + sums[rank]
    return ranked.where(F.col("rank") >= cut), None if had == sum(sums.values()) else ranked.where(F.col("rank") < cut)


def _packed(table: DataFrame) -> bytes:
    """A table of bounded size as an Arrow stream for the tasks."""
    got, sink = table.toArrow(), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, got.schema) as out:
        out.write_table(got)
    return sink.getvalue().to_pybytes()


def _loaded(name: str, raw: bytes) -> dict[str, bytes]:
    """The table of the tasks as a dictionary, made once in a process; those of earlier runs go."""
    if name not in _tables:
        _tables.clear()
        got = pa.ipc.open_stream(raw).read_all()
        _tables[name] = dict(zip(got.column("chunk").to_pylist(), got.column("ids").to_pylist(), strict=True))
    return _tables[name]


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", text_col: str = "text", ids: bool = False, most_chunks: int = MOST_CHUNKS, join_rest: bool = False) -> DataFrame:
    """Encode whole texts as the library does, begin and end ids included, and decode them again.

    The columns of ``docs`` come back, then ``n_tokens`` (all ids), ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
    words), ``decoded_sha256`` (of the decoded text) and, with ``ids``, the ``ids`` and the ``decoded`` text; these replace
    columns of the same names.  Null and empty texts have the begin and the end id only.  Repeated rows have equal results, an
    empty table gives an empty table.  ``model``: a name in the public tokenizers' folder, or a path; with a model whose
    pieces cross marks, whole texts are encoded.
    """
    inner, (text,) = positional(docs, text_col)
    new = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    if ids:
        new += [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    extras = "array<struct<chunk:string,ids:binary>>"
    name, rest = uuid.uuid4().hex, None
    if encoder(model).separable:
        top, rest = _split_counts(chunk_counts(inner.select(F.col(text).alias("t"))), most_chunks)
        shared = inner.sparkSession.sparkContext.broadcast(_packed(segmented(top, model)))
    else:
        shared = None
    if rest is not None and join_rest:
        rest = written(segmented(rest, model), "rest")

        def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _loaded(name, shared.value)
            for batch in batches:
                out: tuple[list, list, list] = ([], [], [])
                for t, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for c in dict.fromkeys(chunks_of(t)) if t else ():
                        if c not in table:
                            for column, v in zip(out, (a, b, c), strict=True):
                                column.append(v)
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["t1", "t2", "chunk"])

        places = written(inner.select(F.col(text).alias("t"), *text_digest(F.col(text))).mapInArrow(missing, "t1 bigint, t2 bigint, chunk string").distinct(), "places")
        found = places.join(rest, "chunk").groupBy(F.col("t1").alias("h1"), F.col("t2").alias("h2")).agg(F.collect_list(F.struct("chunk", "ids")).alias("extra"))
        found, (t1, t2) = written(found, "found"), text_digest(F.col(text))
        rows = inner.join(found, (t1 == F.col("h1")) & (t2 == F.col("h2")), "left").select(*inner.columns, "extra")
    else:
        rows = inner.withColumn("extra", F.lit(None).cast(extras))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        table = _loaded(name, shared.value) if shared else {}
        for batch in batches:
            out: list[list] = [[] for _ in new]
            for t, extra in zip(batch.column(text).to_pylist(), batch.column("extra").to_pylist(), strict=True):
                raw = e.encode(t or "", table, {x["chunk"]: x["ids"] for x in extra or ()})
                own = np.frombuffer(raw, "<u4").tolist()
                back = e.model.decode(own)
                row = [len(own), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                for column, v in zip(out, [*row, own, back] if ids else row, strict=True):
                    column.append(v)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            yield pa.record_batch([*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(out, kinds, strict=False))], names=[*batch.schema.names[:-1], *(f.name for f in new)])

    done = rows.mapInArrow(run, StructType([*inner.schema.fields, *new]))
    names = [f.name for f in new]
    return done.select(*(F.col(c).alias(name) for c, name in zip(inner.columns, docs.columns, strict=True) if name not in names), *names)
