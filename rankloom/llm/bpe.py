"""Byte-level BPE encoding and decoding by DuckDB queries inside each Spark partition.

Encoding.  A text is split by the vocabulary's pattern; each split is encoded on its own, so a
partition encodes only its distinct splits.  They stand in DuckDB as token-position rows (word, pos, id),
at first one row per byte.  A recursive query joins neighbouring rows with the merge table, finds
each word's pair of least rank, contracts it, from the left, and goes on until no pair of any word can
be merged.  All copies of a word's least pair are contracted in one step: every token of a
trained vocabulary is reachable, so a merge never makes a pair of lower rank and the order among
copies does not matter (tests compare with the library).  A step's rows of finished words are the result.

Decoding.  Id-position rows join the vocabulary, and an ordered aggregation by position concatenates
their bytes; bytes are carried as the characters U+0100 to U+01FF.

DuckDB runs inside the Python worker, on one thread and in bounded memory: texts are read in runs of at
most ``RUN_CHARS`` characters (a longer text is split into words as it is read, run by run), new words are handed
over in portions of ``PORTION_BYTES``, ids are decoded ``DECODE_IDS`` at a time, and digests grow as the runs
come.  A worker keeps the words it has encoded (at most ``KEEP_WORDS``, then it starts anew), which only saves time.

Edge cases: a null or empty text has no ids and decodes to no bytes.  Very long texts are read in runs; a
single unbroken word is one portion, whose steps grow with its distinct pairs.  No ties arise: ranks are distinct.
Every input row gives one output row, whatever its id, repeated rows too; an empty table gives none.  Columns other than
the id and the text are not read, whatever their names.  Vocabularies of up to 65,536 ids (a pair is one 32-bit key).
"""

from __future__ import annotations

import functools
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, whole_text
from .vocabulary import ranks_path, read_ranks

KEEP_WORDS = 1_200_000
PORTION_BYTES = 800_000
DUCKDB_MEMORY = "300MB"
RUN_CHARS, RUN_WORDS, DECODE_IDS = 2_000_000, 100_000, 300_000

# Rows of words that can still be merged go round (live); a word's rows come out with live = false
# once no pair of it is in the merge table. Rows stay in order of word and position: the windows over () read
# them as they come, which holds on one thread with joins that probe from the left (see Codec); every result is
# checked against the words' bytes.
CONTRACT = """
WITH RECURSIVE state(word, pos, id, live) AS (
  SELECT word, pos, id, TRUE FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT word, pos, id, CASE WHEN lead(word) OVER () = word THEN lead(id) OVER () END AS right_id FROM state WHERE live),
   ranked AS (
     SELECT word, pos, id, right_id, rank FROM pairs LEFT JOIN merges ON pair = id::BIGINT * 65536 + right_id),
   ranks AS (
     SELECT word, min(rank) AS least FROM ranked GROUP BY word),
   chosen AS (
     SELECT word, pos, id, least, row_number() OVER () AS n, CASE WHEN rank = least THEN id = right_id END AS twin
     FROM ranked LEFT JOIN ranks USING (word)),
   marked AS (
     SELECT word, pos, id, least,
            -- copies of the least pair; in a run of equal ids every second one, from its left end
            twin IS NOT NULL AND (NOT twin OR (n - coalesce(max(CASE WHEN twin IS NULL THEN n END) OVER (ROWS UNBOUNDED PRECEDING), 0)) % 2 = 1) AS merge
     FROM chosen),
   contracted AS (
     SELECT word, pos, id, least, merge, coalesce(lag(merge) OVER (), FALSE) AS gone FROM marked)
   SELECT word, pos, CASE WHEN merge THEN least ELSE id END, least IS NOT NULL FROM contracted WHERE NOT gone)
)
SELECT word, list(id ORDER BY pos) AS ids FROM state WHERE NOT live GROUP BY word ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(token, '' ORDER BY pos) AS bytes FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


def merge_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens that concatenate to a token: left * 65536 + right, and that token's rank."""
    pairs, merged = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.append(left << 16 | right)
                merged.append(rank)
    return np.array(pairs, np.int64), np.array(merged, np.int32)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + size]``, one after another."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Codec:
    """One process's DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        ranks = read_ranks(path)
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids of 16 bits at most")
        self.split, self.matches = regex.compile(pattern).findall, regex.compile(pattern).finditer
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": "", "preserve_insertion_order": True})
        self.db.execute("SET disabled_optimizers = 'join_order,build_side_probe_side'")
        pair, rank = merge_pairs(ranks)
        arrow = pa.table({"pair": pair, "rank": rank})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM arrow")
        arrow = pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                          "token": ["".join(chr(256 + b) for b in token) for token in ranks]})  # noqa: F841
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM arrow")
        self.token_sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.token_sizes[list(ranks.values())] = [len(token) for token in ranks]
        self.token_starts = np.zeros_like(self.token_sizes)
        self.token_starts[list(ranks.values())] = np.cumsum([0, *(len(token) for token in ranks)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(ranks), np.uint8)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)     # of all known words, one after another
        self.starts = np.zeros(1, np.int64)   # where each begins, and the end

    def learn(self, words: list[str]) -> None:
        """Encode new words, in portions."""
        portion, size = [], 0
        for word in words:
            data = word.encode()
            if portion and size + len(data) > PORTION_BYTES:
                self._learn(portion)
                portion, size = [], 0
            portion.append((word, data))
            size += len(data)
        if portion:
            self._learn(portion)

    def _learn(self, portion: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(data) for _, data in portion])
        word = np.repeat(np.arange(len(portion), dtype=np.int32), lengths)
        first = np.cumsum(lengths) - lengths
        pos = (np.arange(len(word)) - np.repeat(first, lengths)).astype(np.int32)
        data = np.frombuffer(b"".join(data for _, data in portion), np.uint8)
        ids = self.byte_ids[data]
        start = pa.table({"word": word, "pos": pos, "id": ids})
        self.db.register("start", start)
        found = self.db.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("start")
        found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
        out = found.flatten().to_numpy()
        if not np.array_equal(gather(self.token_bytes, self.token_starts[out], self.token_sizes[out]), data):
            raise RuntimeError("DuckDB did not keep the order of the rows")
        base = len(self.known)
        self.known.update((w, base + n) for n, (w, _) in enumerate(portion))
        self.starts = np.concatenate([self.starts, self.starts[-1] + found.offsets.to_numpy()[1:] - found.offsets[0].as_py()])
        self.ids = np.concatenate([self.ids, out.astype(np.uint32)])

    def _runs(self, texts: list[str]):
        """Lists of (number of the text, words), at most about ``RUN_CHARS`` characters together, in order."""
        held, size = [], 0
        for n, text in enumerate(texts):
            if held and size + len(text) > RUN_CHARS:
                yield held
                held, size = [], 0
            if len(text) <= RUN_CHARS:
                held.append((n, self.split(text)))
                size += len(text)
                continue
            words = (m.group() for m in self.matches(text))
            while part := list(islice(words, RUN_WORDS)):
                yield [(n, part)]
        if held:
            yield held

    def runs(self, texts: list[str]):
        """Lists of (number of the text, ids), a run at a time; a long text's ids come over several runs."""
        for run in self._runs(texts):
            new = set().union(*(words for _, words in run)).difference(self.known)
            if new and len(self.known) + len(new) > KEEP_WORDS:
                self.forget()
                new = set().union(*(words for _, words in run))
            self.learn(sorted(new))
            out = []
            for n, words in run:
                at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                out.append((n, gather(self.ids, self.starts[at], self.starts[at + 1] - self.starts[at])))
            yield out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts = [[] for _ in texts]
        for run in self.runs(texts):
            for n, ids in run:
                parts[n].append(ids)
        return [np.concatenate([np.zeros(0, np.uint32), *p]) for p in parts]

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        sizes = np.array([len(x) for x in lists], np.int64)
        doc = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
        flat = np.concatenate([*lists, np.zeros(0, np.uint32)]).astype(np.int32)
        out = [[] for _ in lists]
        for first in range(0, len(flat), DECODE_IDS):
            part = slice(first, first + DECODE_IDS)
            ids = pa.table({"doc": doc[part], "pos": np.arange(len(flat[part]), dtype=np.int32), "id": flat[part]})
            self.db.register("ids", ids)
            for n, text in self.db.sql(DECODE).fetchall():
                out[n].append((np.frombuffer(text.encode("utf-16-le"), "<u2") - 256).astype(np.uint8).tobytes())
            self.db.unregister("ids")
        return [b"".join(x) for x in out]


@functools.lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)``."""
    path, pattern = path or ranks_path(), pattern or _pattern()

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            lists = own.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return map_arrow(docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")), run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, bytes binary)`` of ``(doc_id, ids)``; null ids decode to no bytes."""
    path, pattern = path or ranks_path(), pattern or _pattern()

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            lists = [np.array(x or [], np.uint32) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.decode(lists), pa.binary())], names=["doc_id", "bytes"])

    schema = T.StructType([T.StructField("doc_id", encoded.schema["doc_id"].dataType), T.StructField("bytes", T.BinaryType())])
    return map_arrow(encoded.select("doc_id", "ids"), run, schema)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The contract's columns; ids and bytes stay in the task that made them."""
    path, pattern = path or ranks_path(), pattern or _pattern()

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            tokens = [0] * batch.num_rows
            encoded, decoded = ([hashlib.sha256() for _ in tokens] for _ in range(2))
            for part in own.runs(batch.column(1).to_pylist()):
                for (n, ids), data in zip(part, own.decode([ids for _, ids in part])):
                    tokens[n] += len(ids)
                    encoded[n].update(ids.astype("<u4").tobytes())
                    decoded[n].update(data)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64()), *(pa.array([h.hexdigest() for h in x]) for x in (encoded, decoded))], names=schema.names)

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return map_arrow(docs.select("doc_id", whole_text().alias("text")), run, schema)
