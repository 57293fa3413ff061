"""Operator 10: byte-level BPE encoding and decoding with recursive DuckDB queries inside Spark tasks.

Each task splits its texts with the tokenizer's pattern, gathers the pieces that it has not met,
and encodes those in one recursive query: the rows are (piece, position, id), they join the merge
table, and every step contracts the leftmost pair of least rank until no pair joins. An ordered
aggregation puts the bytes of the ids together again. Pieces that are tokens as a whole are that
token. No shuffle: texts stay in the partition that read them.

Long pieces are encoded in chunks. A sequence of tokens is what the merges make of its bytes exactly if
every two neighbours are what they make of those two's bytes: the first merge across a border of tokens
would have been made among these two alone as well. So encoded stretches can be joined wherever
the tokens on both sides of the joint stood next to each other in some encoded stretch over it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches

#: Pieces kept per generation of a worker's cache; two generations are held, so memory is bounded.
CACHE = 600_000
#: Bytes of chunks in one recursive query.
CHUNK_BYTES = 400_000
#: Pieces above this many bytes are encoded in chunks of so many, which are stitched where their tokens agree.
CHUNK = 48

STEP = """
    select * from (with pairs as materialized (
        select p.*, m.rank, m.rank::bigint * 4294967296 + p.pos as key from (
            select step, w, pos, id, lead(id) over win as next_id, lead(pos) over win as next_pos, lead(w) over win as next_w from t window win as (order by w, pos)
        ) p left join merges m on p.id = m.a and p.next_id = m.b and p.w = p.next_w)
    select p.step + 1 as step, p.w, p.pos, case when p.key = best.key then p.rank else p.id end as id
    from pairs p join (select w, min(key) as key, arg_min(next_pos, key) as gone from pairs where key is not null group by w) best on p.w = best.w
    where p.pos <> best.gone)
"""
RECURSIVE = """
    create or replace temp table done as
    with recursive t(step, w, pos, id) as (select 0, w, pos, id from base union all {step})
    select t.w, t.pos, t.id from t join (select w, max(step) as last from t group by w) f on t.w = f.w and t.step = f.last
""".format(step=STEP)
ORDERED = """
    select w, list(d.id order by pos) as ids, list(v.tok order by pos) as toks
    from done d join vocab v on d.id = v.id group by w
"""


class DuckBpe:
    """Encoder of single pieces over a rank table {bytes: rank}; one DuckDB connection with one thread."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb
        import pandas as pd

        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        rows = [
            (ranks[tok[:i]], ranks[tok[i:]], rank)
            for tok, rank in ranks.items()
            for i in range(1, len(tok))
            if tok[:i] in ranks and tok[i:] in ranks
        ]
        merges = pd.DataFrame(rows, columns=["a", "b", "rank"])  # noqa: F841  read by the query below
        vocab = pd.DataFrame({"id": list(ranks.values()), "tok": list(ranks)})  # noqa: F841  read by the query below
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.execute("create table merges as select a::int as a, b::int as b, rank::int as rank from merges")
        self.db.execute("create table vocab as select id::int as id, tok::blob as tok from vocab")

    def encode(self, pieces: list[str]) -> Iterator[tuple[str, bytes, bytes]]:
        """(piece, ids as little-endian 32-bit, bytes decoded from the ids) for each distinct piece."""
        short: dict[bytes, str] = {}
        long: dict[bytes, str] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                yield piece, rank.to_bytes(4, "little"), raw
            else:
                (long if len(raw) > CHUNK else short)[raw] = piece
        for raw, ids, toks in self._merged(short):
            yield short[raw], ids.tobytes(), b"".join(toks)
        for group in _groups(long, 10 * CHUNK_BYTES):
            yield from ((long[raw], np.array(ids, "<u4").tobytes(), b"".join(toks)) for raw, ids, toks in self._stitched(group))

    def _merged(self, chunks: Iterable[bytes]) -> Iterator[tuple[bytes, np.ndarray, list[bytes]]]:
        """(chunk, ids, tokens) of distinct byte strings by the merges alone, one recursive query for many of them."""
        for group in _groups(chunks, CHUNK_BYTES):
            yield from self._contract(group)

    def _contract(self, chunk: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, list[bytes]]]:
        import pandas as pd

        lens = np.array([len(raw) for raw in chunk])
        flat = np.frombuffer(b"".join(chunk), np.uint8)
        starts = np.cumsum(lens) - lens
        piece_rows = pd.DataFrame(  # noqa: F841  read by the query below
            {
                "w": np.repeat(np.arange(len(chunk)), lens).astype(np.int32),
                "pos": (np.arange(len(flat)) - np.repeat(starts, lens)).astype(np.int32),
                "id": self.byte_ids[flat].astype(np.int32),
            }
        )
        self.db.execute("create or replace temp table base as select * from piece_rows")
        self.db.execute(RECURSIVE)
        got = self.db.sql(ORDERED).to_arrow_table()
        ids = got.column("ids").combine_chunks()
        toks = got.column("toks").combine_chunks()
        ends = np.asarray(ids.offsets)
        values = np.ascontiguousarray(np.asarray(ids.values), dtype="<u4")
        parts = toks.values.to_pylist()
        tok_ends = np.asarray(toks.offsets)
        for i, w in enumerate(np.asarray(got.column("w"))):
            yield chunk[w], values[ends[i] : ends[i + 1]], parts[tok_ends[i] : tok_ends[i + 1]]

    def _stitched(self, pieces: list[bytes]) -> Iterator[tuple[bytes, list[int], list[bytes]]]:
        """(piece, ids, tokens) of long pieces: chunks give joints, and the stretches between joints are encoded and checked at them."""
        known: dict[bytes, tuple[list[int], list[bytes]]] = {}

        def learn(stretches: Iterable[bytes]) -> None:
            for raw, ids, toks in self._merged(dict.fromkeys(x for x in stretches if x not in known)):
                known[raw] = ids.tolist(), toks

        learn(raw[i : i + CHUNK] for raw in pieces for i in range(0, len(raw), CHUNK))
        joints: dict[bytes, dict[int, tuple[bytes, bytes]]] = {}
        for raw in pieces:  # the middle of every chunk but the first and the last: where, and the tokens before and after
            own = joints[raw] = {}
            for i in range(CHUNK, len(raw) - CHUNK, CHUNK):
                toks = known[raw[i : i + CHUNK]][1]
                if len(toks) > 1:
                    m = len(toks) // 2
                    own[i + sum(map(len, toks[:m]))] = toks[m - 1], toks[m]
        open_pieces = pieces
        while open_pieces:  # joints that the stretches around them don't agree with go, unless that makes a stretch too long
            cuts = {raw: [0, *joints[raw], len(raw)] for raw in open_pieces}
            learn(raw[a:b] for raw, at in cuts.items() for a, b in zip(at, at[1:], strict=False))
            changed = []
            for raw, at in cuts.items():
                start = 0
                for a, b, c in zip(at, at[1:], at[2:], strict=False):
                    before, after = known[raw[a:b]][1], known[raw[b:c]][1]
                    if (before[-1], after[0]) != joints[raw][b] and c - start <= 8 * CHUNK:
                        del joints[raw][b]
                    else:
                        start = b
                if len(joints[raw]) + 2 < len(at):
                    changed.append(raw)
            open_pieces = changed
        for raw in pieces:
            yield raw, *self._walk(raw, joints[raw], known, learn)

    def _walk(self, raw: bytes, joints: dict[int, tuple[bytes, bytes]], known: dict, learn) -> tuple[list[int], list[bytes]]:
        """The piece's tokens from left to right: a stretch after the other, and around joints that fail, windows that overlap."""
        order = [*joints, len(raw)]
        nth = {at: k for k, at in enumerate(order)}
        ids: list[int] = []
        toks: list[bytes] = []
        pos, need, k, size = 0, None, 0, CHUNK  # need: the token that has to follow for the last border to hold
        while pos < len(raw):
            end = order[k]
            own_ids, own = known[raw[pos:end]] if raw[pos:end] in known else ([], [])
            if own and need in (None, own[0]) and (end == len(raw) or own[-1] == joints[end][0]):
                ids += own_ids
                toks += own
                pos, need, k, size = end, joints[end][1] if end < len(raw) else None, k + 1, CHUNK
                continue
            end = min(pos + size, len(raw))
            learn([raw[pos:end]])
            own_ids, own = known[raw[pos:end]]
            if need not in (None, own[0]):  # the border does not hold: take some tokens back and look at a longer window
                back = max(1, min(len(toks), 4))
                ids, pos, need = ids[:-back], pos - sum(map(len, toks[-back:])), toks[-back]
                toks, size = toks[:-back], 2 * size
                if not pos:
                    need = None
                k = next(i for i, at in enumerate(order) if at > pos)
                continue
            if end == len(raw):
                return ids + own_ids, toks + own
            at, cut = pos, 0
            for j, (a, b) in enumerate(zip(own, own[1:], strict=False), 1):
                at += len(a)
                if joints.get(at) == (a, b):
                    cut = j
                    break
                if not cut and at - pos >= size // 2:
                    cut = j
            if not cut:
                size *= 2
                continue
            ids += own_ids[:cut]
            toks += own[:cut]
            pos, need = pos + sum(map(len, own[:cut])), own[cut]
            k = nth[pos] + 1 if pos in nth else next(i for i in range(k, len(order)) if order[i] > pos)
        return ids, toks


def _groups(strings: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """The strings in lists of about so many bytes together."""
    group, held = [], 0
    for s in strings:
        group.append(s)
        held += len(s)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


class PieceCache:
    """What single pieces encode to, in two generations: the older one goes when the newer is full."""

    def __init__(self, encoder, size: int = CACHE):
        self.encoder, self.size = encoder, size
        self.new: dict = {}
        self.old: dict = {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Have every one of the pieces in the newer generation."""
        missing = [p for p in pieces if p not in self.new]
        if len(self.new) + len(missing) > self.size:
            self.old, self.new = self.new, {}
            missing = list(pieces)
        unknown = []
        for p in missing:
            if (got := self.old.get(p)) is not None:
                self.new[p] = got
            else:
                unknown.append(p)
        for piece, ids, raw in self.encoder.encode(unknown):
            self.new[piece] = (ids, raw)


def load_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_WORKER: dict[str, PieceCache] = {}


def _cache(rank_file: str) -> PieceCache:
    if rank_file not in _WORKER:
        _WORKER[rank_file] = PieceCache(DuckBpe(load_ranks(rank_file)))
    return _WORKER[rank_file]


def bpe(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also ids (array<int>) and
    decoded (binary). rank_file and pattern are the tokenizer's; the file must be at that path on every
    executor. A null text counts as empty: no tokens. Repeated rows and null ids give a row each; other
    columns of docs, whatever their names, are not read.
    """
    short_batches(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded binary"

    def encode(batches):
        import pyarrow as pa
        import regex

        find = regex.compile(pattern).findall
        cache = _cache(rank_file)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in _slices(texts, 4_000_000):
                pieces = [find(t) if t else [] for t in texts[lo:hi]]
                cache.learn(set().union(*pieces))
                known = cache.new
                out: list[list] = [[], [], [], [], []]
                for own in pieces:
                    pairs = [known[p] for p in own]
                    ids = b"".join([a for a, _ in pairs])
                    raw = b"".join([b for _, b in pairs])
                    row = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest()]
                    row += [np.frombuffer(ids, "<u4").astype(np.int32), raw] if keep_ids else []
                    for col, value in zip(out, row, strict=False):
                        col.append(value)
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    arrays += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), *arrays], names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, schema)


def _slices(texts: list, chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many characters together."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
