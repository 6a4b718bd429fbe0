"""Token-ID output (operator 5): id blocks as byte or bit planes, each compressed with zstandard.

File format (a Parquet table, one row per chunk, so that Spark's committer handles retried tasks):

===========  ==================================================================================
shard        number of the range of doc_ids; shards ascend, and documents ascend within one
chunk        number of the chunk in its shard
first        position of the chunk's first id in the shard
n_ids        ids in the chunk (``block`` of them, fewer in a shard's last chunk)
planes       'byte' or 'bit'
plane_sizes  the chunk index: length of each compressed plane within ``data``
data         the compressed planes, one after the other
doc_no       numbers (in the shard) of the documents that have ids here
doc_id       their ids
doc_at       offset of each one's first id here
doc_part     0 where a document begins in this chunk, else how many chunks it has begun before
===========  ==================================================================================
"""

from __future__ import annotations

import codecs
import os
import re
import uuid
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from mapjobs.llm.common import crc32, held, release, slices, texts
from mapjobs.session import partitions, shared_dir

CHUNKS = "shard long, chunk long, first long, n_ids long, planes string, plane_sizes array<int>, data binary, doc_no array<long>, doc_id array<long>, doc_at array<int>, doc_part array<int>"
PARTS = "shard long, doc_no long, part int, doc_id long, at long, n long, crc long, ids binary"

#: Unicode white space, written out because regular expression engines differ on a few control characters.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: ASCII punctuation without the apostrophe, which can begin a contraction.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: About the bytes that an entry of a dictionary takes beside the letters and ids.
ENTRY = 200
#: The byte-level vocabulary never merges across these pieces of text.
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Put between the pieces of texts that do not hold it.
MARK = "\x01"
#: Texts that are not cut at blanks and line feeds alone.
ODD = f"[{SPACE}][{SPACE}]|[{SPACE.replace(' ', '').replace('\t-\r', '\t\x0b-\r')}{MARK}]"
#: Words given to the model at a time.
LISTED = 100


class Encoder:
    """Ids of texts by a byte-level BPE of the tokenizers library.

    Its pre-tokenizer breaks before every run of white space and before the last blank in front of a word,
    so the ids of a text are those of the pieces between these breaks. It also breaks between letters and ASCII punctuation (but for the apostrophe), so
    a piece of letters is one input of the BPE model, and one with such signs behind it is two. Any other pieces are
    encoded whole. Pieces repeat: Arrow cuts a batch's texts and finds the different words in them, which go to the model many
    at a time, once a batch. The few other inputs are kept in ``most`` bytes, after which those not met again are forgotten.
    """

    def __init__(self, path: str, end_id: int, most: int = 16 << 20):
        from tokenizers import Tokenizer, pre_tokenizers

        # a task is one core's: the library shall not start threads of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end, self.most, self.known, self.older = np.uint32(end_id).tobytes(), most, {}, {}
        self.size = 0
        # the byte-level alphabet: a printable character for each byte, as the vocabulary file spells them
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.bpe, self.spelling = self.tokenizer.model.tokenize, "".join(alphabet[b] for b in range(256))
        # the same model for lists of words with a blank in front of each, which only the first id of a word begins with
        self.listed = Tokenizer(self.tokenizer.model)
        self.listed.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(alphabet[10])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] == alphabet[32]]] = True

    def _spelt(self, text: str) -> str:
        return codecs.charmap_decode(text.encode(), "strict", self.spelling)[0]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _one(self, piece: str) -> bytes:
        found = self.bpe(self._spelt(piece))
        return pack(f"<{len(found)}I", *[x.id for x in found])

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of different words of letters with a blank in front."""
        lists = pa.ListArray.from_arrays([*range(0, len(words), LISTED), len(words)], words)
        ids = [np.zeros(0, "<u4")]
        for x in pc.binary_join(lists, pa.scalar("\n", words.type)).to_pylist():
            ids.append(np.array(self.listed.encode_batch_fast([self._spelt(x)], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(ids)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):  # a vocabulary without the blank
            return pa.array(map(self._one, words.to_pylist()), pa.large_binary())
        bounds = np.append(starts, len(ids)) * 4
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])

    def _others(self, pieces: pa.Array) -> pa.Array:
        """Ids of different words without a blank, signs and whole pieces."""
        if self.size > self.most // 2:
            self.known, self.older, self.size = {}, self.known, 0
        known, pieces = self.known, pieces.to_pylist()
        for p in pieces:
            if p not in known:
                known[p] = ids = self.older.get(p) or (self._one(p) if p.isalpha() else self._whole(p))
                self.size += len(p) + len(ids) + ENTRY
        return pa.array([known[p] for p in pieces], pa.large_binary())

    def _heads(self, heads: pa.Array) -> pa.Array:
        found = heads.dictionary_encode()
        listed = pc.match_substring_regex(found.dictionary, r"^ \pL+$")
        words, others = found.dictionary.filter(listed), found.dictionary.filter(pc.invert(listed))
        ids = pa.concat_arrays([self._words(words), self._others(others)])
        mask = listed.to_numpy(zero_copy_only=False)
        return ids.take(pa.array(np.where(mask, np.cumsum(mask) - 1, len(words) + np.cumsum(~mask) - 1))).take(found.indices)

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces."""
        heads = pc.utf8_rtrim(pieces, SIGNS)
        heads = pc.if_else(pc.match_substring_regex(heads, r"^ ?\pL+$"), heads, pieces)
        signed = pc.not_equal(pc.binary_length(heads), pc.binary_length(pieces))
        signs = pc.replace_substring_regex(pieces.filter(signed), r"^ ?\pL+", "").dictionary_encode()
        ids = self._heads(heads)
        behind = self._others(signs.dictionary).take(signs.indices)
        return pc.replace_with_mask(ids, signed, pc.binary_join_element_wise(ids.filter(signed), behind, pa.scalar(b"", ids.type)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its little-endian unsigned 32-bit ids, with the end id."""
        given = pa.array(texts, pa.large_string())
        # where white space stands singly and is blanks and line feeds alone, a piece ends before each and after a line feed
        odd = pc.match_substring_regex(given, ODD)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(given, s))
        marked = pc.replace_substring(pc.replace_substring(given.filter(pc.invert(odd)), " ", MARK + " "), "\n", f"{MARK}\n{MARK}")
        cut = pc.split_pattern(marked, MARK)
        others = [None if any(s in t for s in self.special) else PIECES.findall(t) for t in given.filter(odd).to_pylist()]
        cut = pa.concat_arrays([cut, pa.array([p or [] for p in others], cut.type)])
        coded = cut.flatten().dictionary_encode()
        ids = self._pieces(coded.dictionary).take(coded.indices)
        joined = pc.binary_join(type(cut).from_arrays(cut.offsets, ids), pa.scalar(b"", ids.type)).to_pylist()
        simple, rest = iter(joined[:len(marked)]), iter(zip(others, joined[len(marked):]))
        out = []
        for t, is_odd in zip(texts, odd.to_pylist()):
            pieces, here = next(rest) if is_odd else ((), next(simple))
            out.append((self._whole(t) if pieces is None else here) + self.end)
        return out


def encoder_of(path: str, end_id: int) -> Encoder:
    """A worker process keeps its encoder over the tasks of this operator."""
    return held(("tokens", path, end_id), lambda: Encoder(path, end_id))


def to_planes(ids: np.ndarray, planes: str, level: int) -> tuple[bytes, list[int]]:
    import zstandard

    packer = zstandard.ZstdCompressor(level=level)
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == "byte":
        rows = list(by_byte)
    else:
        rows = [np.packbits((by_byte[b // 8] >> (b % 8)) & 1) for b in range(32)]
    packed = [packer.compress(r.tobytes()) for r in rows]
    return b"".join(packed), [len(p) for p in packed]


def from_planes(data: bytes, sizes: list[int], n: int, planes: str) -> np.ndarray:
    import zstandard

    reader, at, rows = zstandard.ZstdDecompressor(), 0, []
    for size in sizes:
        rows.append(np.frombuffer(reader.decompress(data[at:at + size]), np.uint8))
        at += size
    if planes == "byte":
        by_byte = np.stack([r[:n] for r in rows])
    else:
        by_byte = np.zeros((4, n), np.uint8)
        for b, r in enumerate(rows):
            by_byte[b // 8] |= np.unpackbits(r, count=n) << np.uint8(b % 8)
    return np.ascontiguousarray(by_byte.T).view("<u4").ravel()


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int = 0, block: int = 65_536, planes: str = "byte", level: int = 3, shards: int | None = None) -> None:
    """Writes docs (doc_id, text) as a token table at ``path``, in ascending doc_id order.

    Ranges of doc_id are dealt to ``shards`` tasks (the session's shuffle partitions unless given), sorted there, and encoded after
    the shuffle, so encoding runs once. A task holds one chunk and one document at a time. Null text
    counts as empty and yields the end id alone; a null doc_id sorts first; rows that repeat a doc_id
    stay apart, in any order among themselves; no rows write an empty table. Other columns are ignored.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = encoder_of(tokenizer, end_id), TaskContext.get().partitionId()
        chunk = first = filled = doc_no = 0
        held: list[bytes] = []
        rows: list[tuple] = []

        def flush():
            nonlocal chunk, first, filled, held, rows
            data, sizes = to_planes(np.frombuffer(b"".join(held), np.uint32), planes, level)
            nos, ids, ats, parts = zip(*rows)
            columns = [[shard], [chunk], [first], [filled], [planes], [sizes], [data], [list(nos)], [list(ids)], [list(ats)], [list(parts)]]
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            chunk, first, filled, held, rows = chunk + 1, first + filled, 0, [], []
            return out

        for batch in slices(batches):
            coded = encoder.encode([t.decode("utf-8", "replace") for t in texts(batch)])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded):
                at = part = 0
                while at < len(ids):
                    took = ids[at:at + 4 * (block - filled)]
                    rows.append((doc_no, doc_id, filled, part))
                    held.append(took)
                    filled, at, part = filled + len(took) // 4, at + len(took), part + 1
                    if filled == block:
                        yield flush()
                doc_no += 1
        if filled:
            yield flush()

    schema = _arrow(docs.sparkSession, CHUNKS)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the second key deals rows that share one doc_id to as many tasks as they need; equal seeds give equal draws where a task is run again
    d = d.repartitionByRange(shards or partitions(docs.sparkSession), "doc_id", F.rand(5)).sortWithinPartitions("doc_id")
    d.mapInArrow(chunks, CHUNKS).write.option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_no, doc_id, start, n_tokens, ids_crc32) from a token table, one row per document.

    Every chunk is decoded by itself. A document that lies in one chunk yields its checksum at once; the parts of
    one that crosses chunks meet in a shuffle on (shard, doc_no). The running start needs one row per shard only.
    """
    schema = _arrow(spark, PARTS)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, "data", 1 << 20):
            for r in batch.to_pylist():
                ids = from_planes(r["data"], r["plane_sizes"], r["n_ids"], r["planes"])
                ends = [*r["doc_at"][1:], r["n_ids"]]
                pieces = [ids[a:b].tobytes() for a, b in zip(r["doc_at"], ends)]
                # only the first and the last document of a chunk can have ids in other chunks
                edge = [r["doc_part"][i] > 0 or i == len(pieces) - 1 for i in range(len(pieces))]
                n = len(pieces)
                columns = [[r["shard"]] * n, r["doc_no"], r["doc_part"], r["doc_id"], [r["first"] + a for a in r["doc_at"]], [len(p) // 4 for p in pieces], [None if e else crc32(p) for e, p in zip(edge, pieces)], [p if e else None for e, p in zip(edge, pieces)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    stored = spark.read.parquet(path)
    found = stored.mapInArrow(parts, PARTS)
    grouped = found.groupBy("shard", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.max("crc").alias("crc"),
        F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("part", "ids")))).alias("parts"),
    )
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    # one row per shard: the number of shards is the writer's parameter, not the size of the data
    shard = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids_here"))
    before = F.sum("ids_here").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    shard = shard.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    return grouped.join(F.broadcast(shard), "shard").select("shard", "doc_no", "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", F.coalesce("crc", F.crc32(joined)).alias("ids_crc32"))


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Writes docs into a new folder of the shared directory and reads the documents back."""
    path = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
