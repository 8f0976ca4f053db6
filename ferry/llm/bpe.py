"""Byte-level BPE: encoding and decoding with recursive DuckDB queries inside each task."""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ferry.llm.common import shipped, text_slices

#: Bytes of texts that are handled at once, and bytes of words that one recursive query
#: takes; a longer text or word goes alone.
TEXT_BYTES, QUERY_BYTES = 4 << 20, 1 << 20
#: Pieces whose ids a worker remembers between batches: a bound on memory, not on results.
REMEMBERED = 300_000

# Token-position rows join the merge table on (token, next token). Per word the leftmost
# pair of least rank is contracted, and in the same round, from left to right, every further
# pair of that rank that overlaps none taken (every other one of a run of such pairs). The
# order is that of one leftmost pair at a time: a contraction's new pairs rank behind it,
# since a token's rank lies behind those of its parts. Rows of words without a pair leave
# the recursion. Ranks are token ids, so the merged token is its own rank. The rounds of a
# word grow with the ranks that occur in it, not with its length.
ENCODE = """
with recursive t(w, pos, tok, live) as (
  select w, pos, tok, true from seed
  union all
  (with pair as materialized (
     select p.w, p.pos, p.tok, p.next_pos, p.i, g.merged, min(g.merged) over (partition by p.w) as least
     from (select w, pos, tok, lead(pos) over o next_pos, row_number() over o i,
                  case when lead(w) over o = w then lead(tok) over o end next_tok
           from t where live window o as (order by pos)) p
     left join merges g on g.l = p.tok and g.r = p.next_tok),
   place as (
     select w, pos, next_pos, least, row_number() over (partition by w, run order by i) k
     from (select *, i - row_number() over (partition by w order by i) run from pair where merged = least)),
   taken as (select * from place where k % 2 = 1)
   select p.w, p.pos, case when a.pos is not null then a.least else p.tok end, p.least is not null
   from pair p left join taken a on a.pos = p.pos
   where p.pos not in (select next_pos from taken))
) select w, list(tok order by pos) ids from t where not live group by w order by w
"""

DECODE = "select string_agg(v.bytes, '' order by s.pos) s from seed s join vocabulary v on v.id = s.id"


class Codec:
    """Tables of one rank file in an in-memory DuckDB, with a bounded memory of encoded pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.classes = char_classes(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(a, b, i) for t, i in self.ranks.items() for k in range(1, len(t))
                 if (a := self.ranks.get(t[:k])) is not None and (b := self.ranks.get(t[k:])) is not None]
        l, r, m = (pa.array(x, pa.int32()) for x in zip(*pairs, strict=True)) if pairs else [pa.array([], pa.int32())] * 3
        self.db = duckdb.connect(config={"threads": "1", "memory_limit": "300MB",
                                      "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        self._table("merges", pa.table({"l": l, "r": r, "merged": m}))
        # bytes as the 256 first code points: string_agg keeps them one to one
        self._table("vocabulary", pa.table({"id": pa.array(self.ranks.values(), pa.int32()),
                                            "bytes": [t.decode("latin-1") for t in self.ranks]}))
        ids = max(self.ranks.values()) + 1
        self.length = np.zeros(ids, np.int64)
        for t, i in self.ranks.items():
            self.length[i] = len(t)
        self.encoded = {t: np.int32(i).tobytes() for t, i in self.ranks.items()}

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def _query(self, sql: str, seed: pa.Table) -> pa.Table:
        self.db.register("seed", seed)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister("seed")

    def _encode_new(self, pieces: list[bytes]) -> list[bytes]:
        size = np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        seed = pa.table({"w": np.repeat(np.arange(len(pieces), dtype=np.int32), size),
                         "pos": np.arange(len(flat), dtype=np.int64), "tok": self.single[flat]})
        ids = self._query(ENCODE, seed)["ids"].combine_chunks()
        ends, values = np.asarray(ids.offsets), np.asarray(ids.values, np.int32)
        return [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _encode_each(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece: its own if it is a token, else remembered or solved."""
        memory = self.encoded
        out = [memory.get(p) for p in pieces]
        todo, held = [], 0

        def run() -> None:
            for i, x in zip(todo, self._encode_new([pieces[i] for i in todo]), strict=True):
                out[i] = x
                if len(memory) < REMEMBERED:
                    memory[pieces[i]] = x

        for i, x in enumerate(out):
            if x is None:
                if todo and held + len(pieces[i]) > QUERY_BYTES:
                    run()
                    todo, held = [], 0
                todo.append(i)
                held += len(pieces[i])
        if todo:
            run()
        return out

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[bounds[i]:bounds[i + 1]]`` end to end, and their bounds."""
        cuts = self.classes.cuts(data, bounds)
        distinct, index = distinct_parts(data, cuts)
        ids, at = gather(self._encode_each(distinct), index)
        return ids.view(np.int32), at[np.searchsorted(cuts, bounds)] // 4

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the id lists ``ids[bounds[i]:bounds[i + 1]]`` end to end, and their bounds."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(bounds), np.int64)
        seed = pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        data = self._query(DECODE, seed)["s"][0].as_py().encode("latin-1")
        sizes = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.length[ids], out=sizes[1:])
        return np.frombuffer(data, np.uint8), sizes[bounds]


def distinct_parts(data: np.ndarray, cuts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct parts ``data[cuts[i]:cuts[i + 1]]``, and for each part the place of its value."""
    if len(cuts) < 2:
        return [], np.zeros(0, np.int64)
    parts = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1,
                                  [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = parts.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices)


def gather(values: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[i]`` for i in index end to end, and the bounds of those."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(index, pa.int64()))
    at = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = taken.buffers()[2] if len(taken) else None
    return (np.frombuffer(data, np.uint8)[: at[-1]] if data is not None else np.zeros(0, np.uint8)), at


class char_classes:
    """Cuts of the rank files' split pattern, found on arrays of code points.

    The pattern's alternatives are, in order: ``'s 't 're 've 'm 'll 'd``, an optional
    space and letters, an optional space and numbers, an optional space and other
    visible characters, white space not followed by a visible character, white space.
    So pieces are runs of one class; the last character of a white-space run before a
    visible character stands apart, or joins what follows if it is a plain space; and a
    lone apostrophe that no space precedes takes a contraction's letters with it.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    LETTER, NUMBER, OTHER, SPACE = range(4)

    def __init__(self, pattern: str):
        if pattern != self.PATTERN:
            raise ValueError("only the split pattern of the byte-level rank files is known")
        self.of = np.full(0x110000, self.OTHER, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for cls, what in ((self.LETTER, r"\p{L}"), (self.NUMBER, r"\p{N}"), (self.SPACE, r"\p{White_Space}")):
            self.of[[ord(x) for x in regex.findall(what, every)]] = cls

    def cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Byte offsets where pieces begin, and the end; texts never share a piece."""
        if not len(data):
            return np.zeros(1, np.int64)
        point = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        first = (data & 0xC0) != 0x80
        byte_at = np.append(np.flatnonzero(first), len(data))
        cls = self.of[point]
        fresh = np.zeros(len(point) + 1, bool)  # a text begins here
        fresh[np.searchsorted(byte_at, bounds)] = True
        cut = np.ones(len(point) + 1, bool)
        cut[1:-1] = cls[1:] != cls[:-1]
        cut |= fresh
        space = cls == self.SPACE
        # the last white space before a visible character of the same text
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~fresh[1:-1])
        cut[last] = True
        cut[last[point[last] == 0x20] + 1] = False
        # contractions
        a = np.flatnonzero((point[:-1] == 0x27) & cut[:-2] & cut[1:-1] & ~fresh[1:-1])
        if len(a):
            one = point[a + 1]
            two = np.where((a + 2 < len(point)), point[np.minimum(a + 2, len(point) - 1)], 0)
            two = np.where(fresh[np.minimum(a + 2, len(point))], 0, two)
            short = np.isin(one, [ord(x) for x in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for at, n in ((a[short], 2), (a[long], 3)):
                cut[at + 1] = False
                cut[at + n] = True
        return byte_at[np.flatnonzero(cut)].astype(np.int64)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
                  text: str = "text") -> DataFrame:
    """Encode every text by the rank file at ``path`` and decode the ids again.

    Adds to the ``keep`` columns: ``token_ids`` array<int>, ``decoded`` binary,
    ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256``. ``path`` is opened on the executors; each holds the rank file as
    part of its environment.

    Each match of ``pattern`` is encoded separately. A match that is itself a token
    becomes it; the others' bytes become token-position rows of a recursive DuckDB
    query that joins the merge table and contracts each word's leftmost pairs of least
    rank until none is left. Decoding joins ids to the vocabulary and aggregates the
    bytes in order. Equal words are solved once per slice of texts.
    Token-position rows of one query stem from at most ``QUERY_BYTES`` bytes or one word.

    A null or empty text gives no ids and zero bytes. Repeated rows each give a row; an
    empty table gives none. Columns not named in ``keep`` are left out, so no name can
    clash unless ``keep`` itself holds one of the added names, which raises.
    """
    added = ["token_ids array<int>", "decoded binary", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    if clash := set(keep) & {x.split()[0] for x in added}:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    fields = docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + added)
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for a, b, data, bounds in text_slices(batch.column("__text"), TEXT_BYTES):
                ids, at = own.encode(data, bounds)
                back, back_at = own.decode(ids, at)
                lists = [ids[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
                texts = [back[x:y].tobytes() for x, y in zip(back_at[:-1], back_at[1:], strict=True)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                       pa.array(texts, pa.binary()), pa.array(np.diff(at), pa.int64()),
                       pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists]),
                       pa.array([hashlib.sha256(x).hexdigest() for x in texts])],
                    names=[*keep, "token_ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"])

    return shipped(rows).mapInArrow(run, schema)
