"""SentencePiece BPE: every distinct marked word is segmented once, ids come back by position."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from ridgeline.llm.common import Digests, DistinctTable, runs, slices

#: Stands for a blank inside pieces.
MARK = "▁"
#: Tab and line feed, which no piece holds.
CONTROL = "\\t\\n"
#: Marks and the word after them, or tabs and line feeds. A piece never goes on beyond one.
CHUNK = re.compile(f"{MARK}*[^{MARK}{CONTROL}]+|{MARK}+|[{CONTROL}]+")
#: Chunks that are looked up at a time, and distinct ones that a worker remembers.
CHUNKS = 1 << 17
REMEMBERED = 300_000
#: Chunks of at most as many characters are segmented side by side, longer ones by a heap.
SHORT = 32
#: Characters that are worked on side by side.
SIDE_BY_SIDE = 1 << 20


class Codec:
    """Encoder and decoder of a byte-fallback BPE model whose pieces do not cross marks."""

    def __init__(self, path: str):
        reader = SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        rules, training = model.normalizer_spec, model.trainer_spec
        names = [p.piece for p in model.pieces]
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if not (
            training.model_type == training.BPE
            and training.byte_fallback
            and not training.treat_whitespace_as_suffix
            and rules.add_dummy_prefix
            and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces
            and not rules.precompiled_charsmap
            and all(p.type not in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        ):
            raise ValueError(f"{path} is not a plain BPE model with byte fallback")
        if any(re.search(f"[^{MARK}]{MARK}|[{CONTROL}]", p) for p in plain):
            raise ValueError(f"{path} has pieces that cross a mark or hold a tab or line feed")
        self.begin, self.end = reader.bos_id(), reader.eos_id()
        self.bytes = [reader.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Characters get their piece's id; those that only occur inside pieces get one beyond the vocabulary.
        self.chars = {c: i for c, i in plain.items() if len(c) == 1}
        for piece in plain:
            for c in piece:
                self.chars.setdefault(c, len(names) + len(self.chars))
        symbol = plain | self.chars
        self.size = len(names)
        self.pairs: dict[int, int] = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = i
        # Equal scores are one rank, among which the leftmost pair goes first.
        places = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.rank = [places[p.score] for p in model.pieces]
        self.ranks = np.array(self.rank, np.int64)
        self.char_ids = np.full(0x110000, -1, np.int32)
        self.char_ids[[ord(c) for c in self.chars]] = list(self.chars.values())
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.joined = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        raw = [b"" if p.type in (kinds.CONTROL, kinds.UNKNOWN) else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        for b, i in enumerate(self.bytes):
            raw[i] = bytes([b])
        raw[reader.unk_id()] = training.unk_surface.encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        self.table = DistinctTable(self.segments, REMEMBERED)

    def segments(self, chunks: list[str]) -> list[Sequence[int]]:
        """Ids of every chunk."""
        out: list[Sequence[int]] = [()] * len(chunks)
        held: list[int] = []
        size = 0
        for n, chunk in enumerate(chunks):
            if len(chunk) > SHORT:
                out[n] = self.segment(chunk)
                continue
            held.append(n)
            size += len(chunk)
            if size >= SIDE_BY_SIDE:
                self._side_by_side(chunks, held, out)
                held, size = [], 0
        if held:
            self._side_by_side(chunks, held, out)
        return out

    def _side_by_side(self, chunks: list[str], which: list[int], out: list) -> None:
        """Ids of short chunks: in every round each chunk joins its best pair, the leftmost among equals."""
        letters = np.frombuffer("".join([chunks[n] for n in which]).encode("utf-32-le"), "<u4")
        sizes = np.array([len(chunks[n]) for n in which], np.int64)
        of = np.repeat(np.arange(len(which)), sizes)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = self.char_ids[letters].astype(np.int64)
        done: list[tuple[np.ndarray, ...]] = []
        none = np.iinfo(np.int64).max

        def order(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """What the symbols ``at`` and those after them make, and when: rank, then place."""
            a, b = ids[at], ids[at + 1]
            key = a << 32 | b
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = (self.keys[slot] == key) & (a >= 0) & (b >= 0) & (of[at] == of[at + 1])
            made = np.where(fits, self.joined[slot], -1)
            return made, np.where(fits, self.ranks[made] * (2 * SHORT) + place[at], none)

        made, when = np.full(len(ids), -1, np.int64), np.full(len(ids), none)
        made[:-1], when[:-1] = order(np.arange(len(ids) - 1))
        while True:
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            first = np.minimum.reduceat(when, starts)
            lengths = np.diff(starts, append=len(of))
            going = first < none
            at_end = np.repeat(~going, lengths)
            done.append((of[at_end], place[at_end], ids[at_end]))
            if not going.any():
                break
            now = np.flatnonzero((when == np.repeat(first, lengths)) & ~at_end)
            ids[now] = made[now]
            stay = ~at_end
            stay[now + 1] = False
            moved = np.cumsum(stay)[now] - 1
            of, place, ids, made, when = (x[stay] for x in (of, place, ids, made, when))
            anew = np.concatenate([moved, moved[moved > 0] - 1])
            last = anew == len(ids) - 1
            made[anew[last]], when[anew[last]] = -1, none
            anew = anew[~last]
            made[anew], when[anew] = order(anew)
        of, place, ids = (np.concatenate(x) for x in zip(*done))
        by = np.lexsort((place, of))
        of, ids = of[by], ids[by]
        cuts = np.searchsorted(of, np.arange(len(which) + 1)).tolist()
        strange = set(of[(ids < 0) | (ids >= self.size)].tolist())
        flat = ids.tolist()
        for k, n in enumerate(which):
            out[n] = self.segment(chunks[n]) if k in strange else flat[cuts[k] : cuts[k + 1]]

    def segment(self, chunk: str) -> tuple[int, ...]:
        """Ids of one chunk: the adjacent pair of the best score is joined first, the leftmost among equals.

        Symbols are a linked list; a heap holds ``rank << 32 | position`` of the
        pairs that make a piece, and an entry whose pair has changed is skipped.
        Characters that are no piece become their UTF-8 bytes in the end.
        """
        get, rank, chars = self.pairs.get, self.rank, self.chars
        ids = [chars.get(c, -1) for c in chunk]
        n = len(ids)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        made = [get(a << 32 | b, -1) if a >= 0 <= b else -1 for a, b in zip(ids, ids[1:])]
        made.append(-1)
        heap = [rank[m] << 32 | i for i, m in enumerate(made) if m >= 0]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFF
            new = made[i]
            if new < 0 or rank[new] != entry >> 32:
                continue
            gone = after[i]
            k = after[i] = after[gone]
            ids[i], made[gone], made[i] = new, -1, -1
            if k < n:
                prior[k] = i
                if ids[k] >= 0 and (m := get(new << 32 | ids[k], -1)) >= 0:
                    made[i] = m
                    heapq.heappush(heap, rank[m] << 32 | i)
            if (p := prior[i]) >= 0:
                m = made[p] = get(ids[p] << 32 | new, -1) if ids[p] >= 0 else -1
                if m >= 0:
                    heapq.heappush(heap, rank[m] << 32 | p)
        out, i, size, raw = [], 0, self.size, self.bytes
        while i < n:
            if 0 <= ids[i] < size:
                out.append(ids[i])
            else:
                out.extend([raw[b] for b in chunk[i].encode()])
            i = after[i]
        return tuple(out)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids of its next part) in order; begin and end ids are left to the caller."""
        marked = (MARK + t.replace(" ", MARK) if t else None for t in texts)
        for group in runs(marked, CHUNK, CHUNKS):
            ids, sizes = self.table.ids_of([c for _, part in group for c in part])
            cuts = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0] + [len(part) for _, part in group])]
            for (row, _), lo, hi in zip(group, cuts, cuts[1:]):
                yield row, ids[lo:hi]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids`` as ``encode`` makes them; the first blank of a text is the caller's to take off."""
        return slices(self.raw, self.raw_start, self.raw_length, ids.astype(np.int64))[0]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and model."""
    return Codec(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text with begin and end ids and decode the ids again, without a shuffle.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and with
    ``with_ids`` also ``ids`` (array of int). ``path`` must exist on every
    executor. A worker keeps one table of distinct chunks (a word with the marks
    before it), segments each new one once, and puts the ids of all chunks of a
    batch in place by their numbers. A mark in a text (U+2581) counts as a
    blank. A NULL text counts as empty: begin and end only, the digest of
    nothing. One row per input row, ids repeated or NULL as they come; other
    columns are not read; an empty table gives an empty result.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        begin, end, none = (np.array(x, np.uintc) for x in ([c.begin], [c.end], []))
        for batch in batches:
            done = Digests(batch.num_rows)
            kept: list[list[np.ndarray]] = [[begin] for _ in range(batch.num_rows)] if with_ids else []
            for row in range(batch.num_rows):
                done.add(row, begin, none)
            for row, ids in c.encode(batch.column(1).to_pylist()):
                first = done.n[row] == 1
                done.add(row, ids, c.decode(ids)[first:])
                if with_ids:
                    kept[row].append(ids)
            for row in range(batch.num_rows):
                done.add(row, end, none)
            arrays = [batch.column(0), *done.arrays()]
            if with_ids:
                whole = [np.concatenate([*parts, end]).astype(np.int32) for parts in kept]
                cuts = pa.array(np.cumsum([0] + done.n).astype(np.int32))
                arrays.append(pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.zeros(0, np.int32), *whole]))))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    ids = F.col(id_col).cast("long").alias("doc_id")
    return docs.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
