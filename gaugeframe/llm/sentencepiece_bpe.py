"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

A text is cut into words first. Two neighbouring characters that stand side by side in no piece
can never be merged, nor can anything across them, so the cut between them is exact; it comes
from the vocabulary alone. Equal words of a chunk are merged once.

All words of a chunk lie in one flat symbol array. In each round every word merges its pair of
smallest rank, at its leftmost place, at all words at once; finished words leave the array
until no pair is left. Two rules keep rounds few without changing any result:

* A word of more than ``WINDOW`` symbols is cut into blocks. A pair that is the smallest of its own
  and both neighbouring blocks merges: before its turn comes, changes from outside reach no
  further than the longest piece, and ``WINDOW`` is four times that.
* Places of one rank merge together, from the left and without overlap, where none of the merges
  makes a new pair of that rank or a smaller one; otherwise only the leftmost merges.

A run of the space symbol, whose pieces all share the last rank, is cut every ``run`` symbols from
the left, which is where its merges end.

Models are read on the driver (their size is that of the vocabulary) and broadcast. Supported are
BPE models with byte fallback, without a character map, user-defined or unused pieces; others are
refused. Null and empty texts have no pieces; repeated rows get equal rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gaugeframe.llm.text import mix, utf8

SPACE = "▁"
NONE = np.int32(2**31 - 1)
CHUNK = 1 << 19  # characters that are merged at once
CODES = 0x110000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format


@dataclass(frozen=True)
class Pieces:
    """The tables of a model."""

    pieces: list[str]
    kinds: np.ndarray
    rank: np.ndarray  # per piece, by falling score; equal scores share a rank
    tied: np.ndarray  # per piece: other pieces of several characters share its rank
    chars: np.ndarray  # per code point: number of a character of longer pieces, or 0
    single: np.ndarray  # per code point: its piece, or the vocabulary size plus the code point
    beside: np.ndarray  # [a, b]: whether characters a, b stand side by side in a piece
    keys: np.ndarray  # sorted left * CODES * 2 + right of all pairs of symbols that merge
    into: np.ndarray  # the piece of each pair
    byte_ids: np.ndarray
    end_id: int
    dummy_prefix: bool
    run: int  # cut runs of the space symbol after so many; 0: never
    window: int

    @classmethod
    def read(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        kinds = np.array([p.type for p in model.pieces], np.int8)
        if spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap \
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or spec.treat_whitespace_as_suffix or not set(kinds) <= {1, 2, 3, 6}:
            raise ValueError(f"{path}: not a plain BPE model with byte fallback")
        names = [p.piece for p in model.pieces]
        scores = np.array([p.score for p in model.pieces], np.float32)
        byte_ids = np.zeros(256, np.int32)
        for i in np.flatnonzero(kinds == BYTE):
            byte_ids[int(names[i][1:-1], 16)] = i
        return cls.of(names, kinds, scores, byte_ids, spec.eos_id, norm.add_dummy_prefix)

    @classmethod
    def of(cls, names, kinds, scores, byte_ids, end_id, dummy_prefix) -> Pieces:
        size = len(names)
        known = {names[i]: i for i in np.flatnonzero(kinds == NORMAL)}
        long = [p for p in known if len(p) > 1]
        single = np.arange(size, size + CODES, dtype=np.int32)
        for p, i in known.items():
            if len(p) == 1:
                single[ord(p)] = i
        chars = np.zeros(CODES, np.int16)
        for k, c in enumerate(sorted({c for p in long for c in p}), 1):
            chars[ord(c)] = k
        beside = np.zeros((chars.max() + 1,) * 2, bool)
        for p in long:
            at = chars[[ord(c) for c in p]]
            beside[at[:-1], at[1:]] = True
        order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        shared = np.bincount(order[[known[p] for p in long]], minlength=size + 1) > 1

        def symbol(part):
            return known.get(part, int(single[ord(part)]) if len(part) == 1 else None)

        pairs = {}
        for p in long:
            for cut in range(1, len(p)):
                left, right = symbol(p[:cut]), symbol(p[cut:])
                if left is not None and right is not None:
                    pairs[left * CODES * 2 + right] = known[p]
        keys = np.array(sorted(pairs), np.int64)
        into = np.array([pairs[k] for k in keys.tolist()], np.int32)
        longest = max(map(len, long), default=1)
        found = cls(names, kinds, order, shared[order], chars, single, beside, keys, into,
                    byte_ids, end_id, dummy_prefix, 0, 4 * longest)
        return cls(**{**found.__dict__, "run": found._run(known, longest)})

    def _run(self, known: dict[str, int], longest: int) -> int:
        """Where merges in a run of spaces end, if its pieces come after all others."""
        n, space = 0, self.chars[ord(SPACE)]
        while SPACE * (n + 1) in known:
            n += 1
        runs = [known[p] for p in known if len(p) > 1 and not p.strip(SPACE)]
        rest = [known[p] for p in known if len(p) > 1 and p.strip(SPACE)]
        n = max((len(self.pieces[i]) for i in runs), default=0)
        if n != longest or len(set(self.rank[runs])) > 1 or (
                rest and self.rank[rest].max() >= self.rank[runs[0]]):
            return 0
        # Nothing but the symbol itself may stand before it in a piece.
        before = np.flatnonzero(self.beside[:, space])
        if list(before) != [space]:
            return 0
        alone = [self._lengths(k) for k in range(3 * n)]
        closed = all(alone[k] == [n, *alone[k - n]] for k in range(n + 1, 3 * n))
        return n if closed else 0

    def _lengths(self, n: int) -> list[int]:
        if n < 2:
            return [1] * n
        flat, _, _ = self.merge(np.repeat(self.single[ord(SPACE)], n), np.array([0]))
        return [len(self.pieces[i]) for i in flat]

    # --- encoding

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols merges into, or -1."""
        key = left.astype(np.int64) * (CODES * 2) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.into[at], -1).astype(np.int32)

    def _ranks(self, into: np.ndarray) -> np.ndarray:
        return np.where(into >= 0, self.rank[into], NONE)

    def merge(self, sym: np.ndarray, first: np.ndarray):
        """Merge words, given as flat symbols and the start of each (at least two symbols).

        Returns flat symbols, and start and length of each word in them.
        """
        ids = np.arange(len(first))
        into = np.full(len(sym), -1, np.int32)
        into[:-1] = self.look_up(sym[:-1], sym[1:])
        into[np.append(first[1:], len(sym)) - 1] = -1
        done, done_ids, done_sizes = [], [], []
        while len(first):
            sizes = np.diff(first, append=len(sym))
            rank = self._ranks(into)
            low = np.minimum.reduceat(rank, first)
            over = low == NONE
            if over.any():
                gone = np.repeat(over, sizes)
                done.append(sym[gone])
                done_ids.append(ids[over])
                done_sizes.append(sizes[over])
                ids, sizes, sym, into, rank = (
                    ids[~over], sizes[~over], sym[~gone], into[~gone], rank[~gone])
                first = np.cumsum(sizes) - sizes
                if not len(first):
                    break
            place = self._chosen(sym, into, rank, first, sizes)
            sym[place] = into[place]
            keep = np.ones(len(sym), bool)
            keep[place + 1] = False
            now = np.cumsum(keep) - 1
            sym, into, first, place = sym[keep], into[keep], now[first], now[place]
            last = np.zeros(len(sym), bool)
            last[np.append(first[1:], len(sym)) - 1] = True
            # Only the pairs around a new symbol change.
            touched = np.zeros(len(sym), bool)
            touched[place] = True
            touched[place[place > 0] - 1] = True
            into[touched] = -1
            touched = np.flatnonzero(touched & ~last)
            into[touched] = self.look_up(sym[touched], sym[touched + 1])
        start, size = np.zeros((2, sum(map(len, done_ids))), np.int64)
        if done:
            which, sizes = np.concatenate(done_ids), np.concatenate(done_sizes)
            start[which], size[which] = np.cumsum(sizes) - sizes, sizes
        return np.concatenate(done) if done else sym, start, size

    def _chosen(self, sym, into, rank, first, sizes) -> np.ndarray:
        """The places whose pairs merge in this round, none next to another."""
        parts = -(-sizes // self.window)
        word = np.repeat(np.arange(len(first)), parts)
        start = first[word] + self.window * (
            np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts))
        low = np.minimum.reduceat(rank, start)
        same = word[1:] == word[:-1]
        before, after = np.full(len(low), NONE), np.full(len(low), NONE)
        before[1:][same], after[:-1][same] = low[:-1][same], low[1:][same]
        area = np.minimum(low, np.minimum(before, after))
        block = np.repeat(np.arange(len(start)), np.diff(start, append=len(sym)))
        hits = np.flatnonzero((rank == area[block]) & (rank != NONE))
        at = block[hits]
        # The leftmost hit of a block, unless the block before has the same rank.
        leftmost = np.ones(len(hits), bool)
        leftmost[1:] = at[1:] != at[:-1]
        chosen = leftmost & (before[at] > area[at])
        several = np.bincount(at, minlength=len(start)) > 1
        several |= (before == area) | (after == area)
        if not several[at].any():
            return hits[chosen]

        # Several places of one rank merge together where all of them are quiet.
        ask = np.flatnonzero(several[at])
        place, piece = hits[ask], into[hits[ask]]
        word_at = word[at[ask]]
        limit = rank[place]
        end = first[word_at] + sizes[word_at]
        loud = self.tied[piece] | (self._ranks(self.look_up(piece, piece)) <= limit)
        left = np.flatnonzero(place > first[word_at])
        loud[left] |= self._ranks(self.look_up(sym[place[left] - 1], piece[left])) <= limit[left]
        right = np.flatnonzero(place + 2 < end)
        loud[right] |= self._ranks(self.look_up(piece[right], sym[place[right] + 2])) <= limit[right]
        bad = np.zeros(len(start), bool)
        bad[at[ask[loud]]] = True
        shut = bad.copy()
        # A neighbour with this rank must have nothing smaller next to it and be quiet too.
        shut[1:] |= same & (bad[:-1] | ((area[:-1] < area[1:]) & (low[:-1] <= area[1:])))
        shut[:-1] |= same & (bad[1:] | ((area[1:] < area[:-1]) & (low[1:] <= area[:-1])))
        # Of overlapping places every second one, counted from where the run begins.
        follows = np.zeros(len(hits), bool)
        follows[1:] = (hits[1:] == hits[:-1] + 1) & (rank[hits[1:]] == rank[hits[:-1]])
        run = np.cumsum(~follows) - 1
        head = np.flatnonzero(~follows)
        odd = (np.arange(len(hits)) - head[run]) % 2 == 1
        cut = np.zeros(len(head), bool)
        cut[run[shut[at]]] = True
        previous = np.maximum(hits[head] - 1, 0)
        cut |= (hits[head] > first[word[at[head]]]) & (rank[previous] == rank[hits[head]])
        chosen |= ~odd & ~cut[run]
        return hits[chosen]

    def _starts(self, codes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character."""
        new = np.ones(len(codes), bool)
        new[1:] = ~self.beside[chars[:-1], chars[1:]]
        return new

    def _symbols(self, codes: np.ndarray, begins: np.ndarray):
        """Symbols of texts that begin at ``begins``: flat, and the number of each text."""
        chars = self.chars[codes]
        new = self._starts(codes, chars)
        new[begins] = True
        if self.run:
            space = codes == ord(SPACE)
            fresh = space.copy()
            fresh[1:] &= ~space[:-1] | new[1:]
            index = np.arange(len(codes), dtype=np.int32)
            since = index - np.maximum.accumulate(np.where(fresh, index, 0))
            new |= space & (since > 0) & (since % self.run == 0)
        first = np.flatnonzero(new)
        size = np.diff(first, append=len(codes))
        single = self.single[codes]
        pool, start, count = [single], first.copy(), np.ones(len(first), np.int64)
        long = np.flatnonzero(size > 1)
        if len(long):
            which, example = self._distinct(chars, first[long], size[long])
            sizes = size[long][example]
            begin = np.cumsum(sizes) - sizes
            flat = np.repeat(first[long][example] - begin, sizes) + np.arange(sizes.sum())
            merged, at, n = self.merge(single[flat], begin)
            pool.append(merged)
            start[long], count[long] = len(single) + at[which], n[which]
        pool = np.concatenate(pool)
        ends = np.cumsum(count)
        out = pool[np.repeat(start - (ends - count), count) + np.arange(ends[-1])]
        # Words never cross from one text to the next.
        text_first = np.searchsorted(first, begins)
        return out, np.diff((ends - count)[text_first], append=ends[-1])

    def _distinct(self, chars, first, size):
        """Number of each word among the distinct ones, and one example of each.

        Words are compared by a hash, and then by their characters.
        """
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) - np.repeat(ends - size, size)
        own = chars[np.repeat(first, size) + place]
        codes = mix(own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
        keys = np.add.reduceat(codes, ends - size)
        _, example, which = np.unique(keys, return_index=True, return_inverse=True)
        if (size[example][which] == size).all():
            other = chars[np.repeat(first[example][which], size) + place]
            if (own == other).all():
                return which, example
        return np.arange(len(first)), np.arange(len(first))

    def _expanded(self, out: np.ndarray, counts: np.ndarray):
        """Ids for symbols: characters that are no piece become the ids of their bytes."""
        rare = np.flatnonzero(out >= len(self.pieces))
        if not len(rare):
            return out, counts
        code = out[rare] - len(self.pieces)
        width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        sizes = np.ones(len(out), np.int64)
        sizes[rare] = width
        ends = np.cumsum(sizes)
        ids = np.repeat(out, sizes)
        data = np.frombuffer("".join(map(chr, code.tolist())).encode(), np.uint8)
        to = np.repeat(ends[rare] - width - (np.cumsum(width) - width), width)
        ids[to + np.arange(len(data))] = self.byte_ids[data]
        text = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(text, sizes, len(counts)).astype(np.int64)

    def _codes(self, text: str) -> np.ndarray:
        text = text.replace(" ", SPACE)
        return np.frombuffer(
            ((SPACE if self.dummy_prefix else "") + text).encode("utf-32-le"), np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each, without an end id."""
        flat, counts = [], np.zeros(len(texts), np.int64)
        held, size = [], 0

        def flush():
            codes = [self._codes(texts[k]) for k in held]
            sizes = np.fromiter(map(len, codes), np.int64)
            out, n = self._expanded(*self._symbols(
                np.concatenate(codes), np.cumsum(sizes) - sizes))
            flat.append(out)
            counts[held] += n

        for k, text in enumerate(texts):
            if not text:
                continue
            if held and size + len(text) > CHUNK:
                flush()
                held, size = [], 0
            if len(text) > CHUNK:  # alone, a stretch at a time
                for part in self._stretches(self._codes(text)):
                    out, n = self._expanded(*self._symbols(part, np.array([0])))
                    flat.append(out)
                    counts[k] += n[0]
                continue
            held.append(k)
            size += len(text)
        if held:
            flush()
        return np.concatenate([*flat, np.empty(0, np.int32)]).astype(np.int32), counts

    def _stretches(self, codes: np.ndarray):
        """Cuts a long text before words, about every ``CHUNK`` characters."""
        begin = 0
        while begin < len(codes):
            end = begin + CHUNK
            while end < len(codes):
                part = codes[end - 1 : end + CHUNK]
                words = np.flatnonzero(self._starts(part, self.chars[part])[1:])
                if len(words):
                    end += int(words[0])
                    break
                end += len(part) - 1
            yield codes[begin:end]
            begin = end

    # --- decoding

    def surfaces(self) -> list[bytes]:
        """What each id stands for inside a text; bytes as themselves."""
        out = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i in np.flatnonzero(self.kinds == CONTROL):
            out[i] = b""
        for i in np.flatnonzero(self.kinds == UNKNOWN):
            out[i] = " ⁇ ".encode()
        for value, i in enumerate(self.byte_ids):
            out[i] = bytes([value])
        return out

    def decoder(self) -> Decoder:
        surfaces = self.surfaces()
        sizes = np.fromiter(map(len, surfaces), np.int64)
        return Decoder(
            np.frombuffer(b"".join(surfaces), np.uint8), np.cumsum(sizes) - sizes, sizes,
            self.kinds, np.array([p.startswith(SPACE) for p in self.pieces]) & (
                self.kinds == NORMAL) & self.dummy_prefix)


@dataclass(frozen=True)
class Decoder:
    """Surface bytes of all ids, flat."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    kinds: np.ndarray
    opens: np.ndarray  # per id: begins with the space that a text gets in front

    def _joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids. The space in front goes; a byte that is no UTF-8 becomes U+FFFD."""
        drop = self._leading(ids)
        data = self._joined(ids).tobytes()
        if self._valid(data):
            return data[drop:]
        out, held = [], []
        for i in [*ids.tolist(), None]:
            if i is not None and self.kinds[i] == BYTE:
                held.append(i)
                continue
            if held:
                out.append(_repaired(self._joined(np.array(held)).tobytes()))
                held = []
            if i is not None:
                out.append(self._joined(np.array([i])).tobytes())
        return b"".join(out)[drop:]

    def _leading(self, ids: np.ndarray) -> int:
        for i in ids.tolist():
            if self.opens[i]:
                return 1
            if self.size[i]:
                return 0
        return 0

    @staticmethod
    def _valid(data: bytes) -> bool:
        try:
            data.decode()
        except UnicodeDecodeError:
            return False
        return True


def _repaired(data: bytes) -> bytes:
    """UTF-8 characters stay; every other byte becomes a replacement character of its own."""
    out, k = [], 0
    while k < len(data):
        for width in (1, 2, 3, 4):
            if Decoder._valid(data[k : k + width]):
                out.append(data[k : k + width])
                k += width
                break
        else:
            out.append("�".encode())
            k += 1
    return b"".join(out)


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids",
           end: bool = True) -> DataFrame:
    """``docs`` with an array column of the ids of its text, and the end id if wanted.

    A null text counts as empty. A column that has the name of the new one gives way to it.
    """
    docs = docs.select(*[c for c in docs.columns if c != ids or c == text])
    kept = [k for k, c in enumerate(docs.columns) if c != ids]
    schema = T.StructType([*[docs.schema[k] for k in kept],
                           T.StructField(ids, T.ArrayType(T.IntegerType(), False))])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        tables = shared.value
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in utf8(batch.column(at))]
            flat, counts = tables.encode(texts)
            ends = np.cumsum(counts)
            if end:
                flat = np.insert(flat, ends, tables.end_id)
                ends = ends + np.arange(1, len(ends) + 1)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            kind = pa.list_(pa.field("element", pa.int32(), False))
            found = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()), type=kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), found], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of an array column of ids; a null array gives the empty text.

    Ids that are null or outside of the vocabulary stand for nothing. A column that has the name
    of the new one gives way to it.
    """
    rows = rows.select(*[c for c in rows.columns if c != text or c == ids])
    kept = [k for k, c in enumerate(rows.columns) if c != text]
    schema = T.StructType([*[rows.schema[k] for k in kept], T.StructField(text, T.StringType())])
    at = rows.columns.index(ids)
    shared = rows.sparkSession.sparkContext.broadcast(pieces.decoder())

    def run(batches):
        tables = shared.value
        for batch in batches:
            column = batch.column(at)
            known = column.values.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            found = []
            for k, valid in enumerate(column.is_valid().to_pylist()):
                own = known[offsets[k] : offsets[k + 1]] if valid else known[:0]
                found.append(tables.decode(own[(own >= 0) & (own < len(tables.size))]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array(found, pa.binary()).cast(pa.string())],
                names=schema.names)

    return rows.mapInArrow(run, schema)
