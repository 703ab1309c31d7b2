"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is a run of words, each with the spaces before it, and no merge crosses a word's start. The
agenda takes the best-scored candidate merge first; a candidate whose keyed hash (seed, document,
word's place in it, word, place, piece) falls below the dropout rate is skipped. So each occurrence
of a word is cut up on its own, the same way in every run.

A candidate makes a part of the word into a piece, so the pieces of an occurrence follow from the word and
from which of its parts that are pieces are skipped. Each distinct such pair is encoded once and
remembered. Without dropout the pieces are the model's own.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.runtime import MEMORIES, numbers, ragged, ship, worker
from graphloom.llm.words import U, chunks, constants, mix, span_hashes

_SALTS = constants(6, 67)
NONE = np.int64(1) << 62
SPACE = "▁"
#: Longer words go through a heap instead of the matrix, which takes a step for each merge.
MATRIX = 48
#: Words of up to so many characters share a matrix, as far as they are longer than the number before.
WIDTHS = (2, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, MATRIX)
#: Distinct words, and pairs of a word and what is skipped in it, that a worker remembers; beyond that it starts afresh.
REMEMBERED = 500_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Table:
    """Numbers by 64-bit key, for many keys at once: an eighth of the slots is filled, so a look-up takes a step or two."""

    def __init__(self, numbers_of: dict[int, int]) -> None:
        self.shift = U(64 - max(4, (8 * len(numbers_of)).bit_length()))
        slots = 1 << 64 - int(self.shift)
        self.keys, self.values, self.steps = np.zeros(slots, U), np.full(slots, -1, np.int64), 1
        keys = np.array(list(numbers_of), U)
        for at, key, value in zip(self._slot(keys).tolist(), keys.tolist(), numbers_of.values()):
            steps = 1
            while self.values[at] >= 0:
                at, steps = (at + 1) % slots, steps + 1
            self.keys[at], self.values[at], self.steps = key, value, max(self.steps, steps)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SALTS[5] >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], -1)
        rest = np.flatnonzero((out < 0) & (self.values[at] >= 0))
        for _ in range(1, self.steps):
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) % len(self.keys)
            here = at[rest]
            hit = self.keys[here] == keys[rest]
            out[rest[hit]] = self.values[here[hit]]
            rest = rest[~hit & (self.values[here] >= 0)]
        return out


def _special(model, i: int) -> bool:
    return model.is_control(i) or model.is_unknown(i) or model.is_unused(i)


def raw_pieces(path: str) -> list[bytes]:
    """The bytes that each piece stands for."""
    from sentencepiece import SentencePieceProcessor

    model, out = SentencePieceProcessor(model_file=path), []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        out.append(bytes([int(name[1:-1], 16)]) if model.is_byte(i) else b"" if _special(model, i) else name.replace(SPACE, " ").encode())
    return out


class Vocabulary:
    """Pieces and their merges."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte = np.full(256, model.unk_id(), np.int64)
        self.ids: dict[str, int] = {}
        for i in range(size):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not _special(model, i):
                self.ids[model.id_to_piece(i)] = i
        order = sorted(self.ids.values(), key=lambda i: (-model.get_score(i), i))
        self.rank = np.zeros(size, np.int64)
        self.rank[order] = np.arange(len(order))
        self.by_rank = np.array(order, np.int64)
        pairs = {}
        for name, i in self.ids.items():
            for cut in range(1, len(name)):
                a, b = self.ids.get(name[:cut]), self.ids.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self.pairs = pairs
        self.pair_pieces = Table(pairs)

        known = {ord(name): i for name, i in self.ids.items() if len(name) == 1 and name != SPACE}
        if SPACE in self.ids:
            known[32] = self.ids[SPACE]
        self.codes = np.array(sorted(known), np.uint32)
        self.code_ids = np.array([known[c] for c in self.codes.tolist()], np.int64)

        longer = {name: i for name, i in self.ids.items() if len(name) > 1}
        self.longest = max(map(len, longer), default=1)
        parts, of_size = {}, {}
        for name in longer:
            of_size.setdefault(len(name), []).append(name)
        for n, names in of_size.items():
            chars = np.frombuffer("".join(names).replace(SPACE, " ").encode("utf-32-le"), np.uint32).reshape(-1, n).astype(U)
            h = np.zeros(len(names), U)
            for c in chars.T:
                h = mix(h * _SALTS[5] + c)
            parts.update(zip(h.tolist(), [longer[name] for name in names]))
        self.part_pieces = Table(parts)

    def parts(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, piece) of all parts of two characters or more that are pieces, by row; chars: words of one length."""
        n, size = chars.shape
        rows, places, pieces = [], [], []
        h = mix(chars.astype(U))
        for more in range(1, min(size, self.longest)):
            h = mix(h[:, : size - more] * _SALTS[5] + chars[:, more:].astype(U))
            piece = self.part_pieces[h.ravel()]
            hit = np.flatnonzero(piece >= 0)
            rows.append(hit // h.shape[1])
            places.append(hit % h.shape[1])
            pieces.append(piece[hit])
        rows, places, pieces = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, places, pieces))
        order = np.argsort(rows, kind="stable")
        return rows[order], places[order], pieces[order]

    def symbols(self, chars: np.ndarray) -> np.ndarray:
        """The piece of each character, or -1; a space is the model's mark, the mark itself is no piece."""
        at = np.minimum(np.searchsorted(self.codes, chars), len(self.codes) - 1)
        return np.where(self.codes[at] == chars, self.code_ids[at], -1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        return np.where((left >= 0) & (right >= 0), self.pair_pieces[(left << 32 | right).view(U)], -1)


def skipped(word: np.ndarray, place: np.ndarray, piece: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate merge into this piece at this place of the word is left out; word: hash with seed, document and place."""
    if rate <= 0:
        return np.zeros(np.shape(piece), bool)
    h = mix((word ^ (place.astype(U) * _SALTS[0])) + piece.astype(U) * _SALTS[1])
    return (h >> U(11)) < U(int(rate * (1 << 53)))


def _agenda(v: Vocabulary, symbols: list[int], word: np.uint64, rate: float) -> list[int]:
    """One word's pieces, by a heap of candidates."""
    n = len(symbols)
    symbols, after, before = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    heap: list[tuple[int, int, int, int]] = []

    def offer(p: int) -> None:
        q = after[p]
        if q >= 0 and symbols[p] >= 0 and symbols[q] >= 0:
            piece = v.pairs.get(symbols[p] << 32 | symbols[q])
            if piece is not None and not skipped(np.array([word]), np.array([p]), np.array([piece]), rate)[0]:
                heapq.heappush(heap, (int(v.rank[piece]), p, symbols[p], symbols[q]))

    for p in range(n):
        offer(p)
    alive = [True] * n
    while heap:
        rank, p, a, b = heapq.heappop(heap)
        q = after[p]
        if not alive[p] or q < 0 or symbols[p] != a or symbols[q] != b:
            continue
        symbols[p], alive[q] = int(v.by_rank[rank]), False
        after[p] = after[q]
        if after[p] >= 0:
            before[after[p]] = p
        offer(p)
        if before[p] >= 0:
            offer(before[p])
    out, p = [], 0
    while p >= 0:
        out.append(p)
        p = after[p]
    return [(symbols[p], p) for p in out]


def _matrix(v: Vocabulary, symbols: np.ndarray, word: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, whether a place begins a piece) of many words, a merge of each at a time; places after a shorter word's end hold -1."""
    n, size = symbols.shape
    symbols = np.concatenate([symbols, np.full((n, 1), -1)], 1)
    after = np.tile(np.arange(1, size + 2), (n, 1))
    before = np.tile(np.arange(-1, size), (n, 1))
    begins = np.ones((n, size), bool)
    cost = np.full((n, size + 1), NONE)

    def offer(rows: np.ndarray, p: np.ndarray) -> None:
        piece = v.merged(symbols[rows, p], symbols[rows, after[rows, p]])
        able = (piece >= 0) & ~skipped(word[rows], p, piece, rate)
        cost[rows, p] = np.where(able, v.rank[np.maximum(piece, 0)], NONE)

    rows = np.arange(n)
    offer(*np.nonzero((symbols[:, :-1] >= 0) & (symbols[:, 1:] >= 0)))
    while len(rows):
        p = cost[rows].argmin(axis=1)
        best = cost[rows, p]
        some = best < NONE
        rows, p, best = rows[some], p[some], best[some]
        if not len(rows):
            break
        q = after[rows, p]
        symbols[rows, p] = v.by_rank[best]
        begins[rows, q] = False
        cost[rows, q] = NONE
        symbols[rows, q] = -1
        r = after[rows, q]
        after[rows, p] = r
        inner = r < size
        before[rows[inner], r[inner]] = p[inner]
        end = r >= size
        after[rows[end], p[end]] = size
        left = before[rows, p]
        some = left >= 0
        offer(np.concatenate([rows, rows[some]]), np.concatenate([p, left[some]]))
    return symbols[:, :size], begins


def _widths(sizes: np.ndarray) -> np.ndarray:
    """The width of the matrix for words of each size; a longer word's own size."""
    return np.where(sizes > MATRIX, sizes, np.array(WIDTHS)[np.minimum(np.searchsorted(WIDTHS, sizes), len(WIDTHS) - 1)])


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, count of them, in a row."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class Memory:
    """Runs of numbers by 64-bit key: columns are the rows of `values`."""

    def __init__(self, columns: int) -> None:
        self.columns = columns
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.zeros(0, U), np.zeros((self.columns, 0), np.int32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of the distinct keys aren't known; where they would make it too large, it forgets all."""
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if len(self.keys) + new.sum() > REMEMBERED:
            self.clear()
            new[:] = True
        return new

    def learn(self, keys: np.ndarray, start: np.ndarray, count: np.ndarray, values: np.ndarray) -> None:
        """keys: sorted, new; start and count: their runs in values."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start, self.count = np.insert(self.start, at, self.values.shape[1] + start), np.insert(self.count, at, count)
        self.values = np.concatenate([self.values, values.astype(np.int32)], 1)


class PieceIds:
    """Piece ids by word, and by word and what is skipped in it, remembered."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.words, self.variants = Memory(1), Memory(1)
        self.parts = Memory(2)  # of each word: places and pieces of its parts

    def _encoded(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each word's ids begin, how many each has, all ids); words are runs of characters."""
        v = self.vocabulary
        count, start, parts, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), [], 0
        wide = _widths(sizes)
        for size in np.unique(wide).tolist():
            group = np.flatnonzero(wide == size)
            inside = np.arange(size) < sizes[group][:, None]
            chars = codes[np.minimum(first[group][:, None] + np.arange(size), len(codes) - 1)]
            symbols = np.where(inside, v.symbols(chars), -1)
            if size <= MATRIX:
                pieces, begins = _matrix(v, symbols, keys[group], rate)
                begins &= inside
            else:
                pieces, begins = symbols.copy(), np.zeros(symbols.shape, bool)
                for row, i in enumerate(group.tolist()):
                    found = _agenda(v, symbols[row].tolist(), keys[i], rate)
                    places = [p for _, p in found]
                    begins[row, places], pieces[row, places] = True, [x for x, _ in found]
            plain = ~((pieces < 0) & begins).any(axis=1)
            for own, whole in ((plain, True), (~plain, False)):
                some, p, b = group[own], pieces[own], begins[own]
                if not len(some):
                    continue
                if whole:
                    flat, each = p[b], b.sum(axis=1)
                else:  # a character that is no piece becomes its bytes
                    rows = [[y for x, c in zip(pr[br].tolist(), cr[br].tolist()) for y in ([x] if x >= 0 else v.byte[list(chr(c).encode())])] for pr, br, cr in zip(p, b, chars[own])]
                    each = np.array([len(r) for r in rows])
                    flat = np.array([x for r in rows for x in r], np.int64)
                count[some] = each
                start[some] = total + np.cumsum(each) - each
                parts.append(flat.astype(np.int32))
                total += len(flat)
        return start, count, np.concatenate(parts)[None] if parts else np.zeros((1, 0), np.int32)

    def _parts(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, count, places and pieces) of the parts of each word; a word too long for the matrix has the one part (-1, -1)."""
        found = []
        for size in np.unique(sizes).tolist():
            group = np.flatnonzero(sizes == size)
            if size <= MATRIX:
                rows, places, pieces = self.vocabulary.parts(codes[first[group][:, None] + np.arange(size)])
                found.append((group[rows], places, pieces))
            else:
                found.append((group, np.full(len(group), -1), np.full(len(group), -1)))
        of, places, pieces = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(of, kind="stable")
        count = np.bincount(of, minlength=len(sizes))
        return np.cumsum(count) - count, count, np.stack([places[order], pieces[order]])

    def of(self, data: np.ndarray, offsets: np.ndarray, document: np.ndarray, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many of each). Texts begin with a space that stands for the model's prefix."""
        space = data == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        word = span_hashes(data, starts, ends, 61)
        distinct, example, which = np.unique(word, return_index=True, return_inverse=True)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        begin_at, sizes = chars[starts], chars[ends] - chars[starts]
        new = self.words.missing(distinct)
        if new.any():
            if not len(self.words.keys):
                self.parts.clear()
            some = example[new]
            self.words.learn(distinct[new], *self._encoded(codes, begin_at[some], sizes[some], distinct[new], 0.0))
            if rate > 0:
                self.parts.learn(distinct[new], *self._parts(codes, begin_at[some], sizes[some]))
        place = np.searchsorted(self.words.keys, distinct)[which]
        start, count, ids = self.words.start[place], self.words.count[place], self.words.values[0]
        if rate > 0:
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            keys = occurrence_keys(document[text], np.arange(len(starts)) - first[text], seed, word)
            varied, marks = self._skips(place, keys, rate)
            marks = mix(marks ^ word[varied])
            distinct, example, which = np.unique(marks, return_index=True, return_inverse=True)
            new = self.variants.missing(distinct)
            if new.any():
                some = varied[example[new]]
                self.variants.learn(distinct[new], *self._encoded(codes, begin_at[some], sizes[some], keys[some], rate))
            at = np.searchsorted(self.variants.keys, distinct)[which]
            start[varied], count[varied] = len(ids) + self.variants.start[at], self.variants.count[at]
            ids = np.concatenate([ids, self.variants.values[0]])
        return ids[_spread(start, count)], np.diff(np.concatenate([[0], np.cumsum(count)])[first])

    def _skips(self, place: np.ndarray, keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """(occurrences in which parts are skipped, a hash of which these are); place: of their words."""
        varied, marks = [], []
        for lo in range(0, len(place), 50_000):
            n = self.parts.count[place[lo : lo + 50_000]]
            of = np.repeat(np.arange(lo, lo + len(n)), n)
            at, piece = self.parts.values[:, _spread(self.parts.start[place[lo : lo + 50_000]], n)].astype(np.int64)
            out = np.flatnonzero(skipped(keys[of], at, piece, rate) | (piece < 0))
            if len(out):
                of, at, piece = of[out], at[out], piece[out]
                mark = mix(at.astype(U) * _SALTS[0] + piece.astype(U) * _SALTS[1] + U(1))
                mark[piece < 0] = keys[of[piece < 0]]
                head = np.flatnonzero(np.diff(of, prepend=-1))
                varied.append(of[head])
                marks.append(np.add.reduceat(mark, head))
        return np.concatenate(varied) if varied else np.zeros(0, np.int64), np.concatenate(marks) if marks else np.zeros(0, U)


def occurrence_keys(document: np.ndarray, nth: np.ndarray, seed: int, word: np.ndarray) -> np.ndarray:
    """The key of each occurrence: of its document, its place in it, the seed and its word."""
    key = mix(document.astype(np.int64).view(U) * _SALTS[2]) + nth.astype(U) * _SALTS[3] + U(seed * int(_SALTS[4]) & (1 << 64) - 1)
    return mix(mix(key) ^ word)


_PIECE_IDS: dict[str, PieceIds] = {}
MEMORIES["pieces"] = _PIECE_IDS.clear


def _encode(path: str, rate: float, seed: int):
    @worker("pieces")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _PIECE_IDS:
            _PIECE_IDS[path] = PieceIds(path)
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
            document = numbers(pc.fill_null(batch["doc_id"], -1))
            for at, end, data, offsets in chunks(texts):
                ids, counts = _PIECE_IDS[path].of(data, offsets, document[at:end], rate, seed)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, end - at), ragged(counts, ids, pa.int32())], ["doc_id", "ids"])

    return run


def encode_pieces(docs: DataFrame, rate: float = 0.1, seed: int = 7, model: str | None = None) -> DataFrame:
    """(doc_id, ids): the piece ids of every whole text, with merges dropped at this rate.

    A null text and an empty one have no ids. Characters that are no piece become byte pieces, and so does
    the model's own space mark where a text holds it; so decoding gives back every text. Rows may
    share a doc_id or have none. Very long texts are encoded whole. An empty table gives no rows.
    Other columns of docs don't matter.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encode(model or default_model(), rate, seed), "doc_id long, ids array<int>")


_RAW: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _decode(path: str):
    @worker("pieces")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _RAW:
            raw = raw_pieces(path)
            size = np.array([len(r) for r in raw])
            _RAW[path] = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size
        flat, first, size = _RAW[path]
        for batch in batches:
            texts, crcs, counts = [], [], []
            for lo in range(0, len(batch), 256):
                lists = batch["ids"].slice(lo, 256)
                ids = numbers(lists.flatten())
                bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
                n = size[ids]
                at = np.repeat(first[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                data = flat[at].tobytes()
                ends = np.concatenate([[0], np.cumsum(n)])[bounds]
                for a, b, lo_id, hi_id in zip(ends[:-1].tolist(), ends[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    try:
                        texts.append(data[min(a + 1, b) : b].decode())
                    except UnicodeDecodeError:
                        texts.append(None)
                    crcs.append(zlib.crc32(ids[lo_id:hi_id].astype("<u4").tobytes()))
                    counts.append(hi_id - lo_id)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_pieces", "ids_crc32", "text"])

    return run


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, text) of rows (doc_id, ids). Null or no ids give an empty text; ids of
    control pieces stand for nothing; ids whose bytes aren't UTF-8, which no encoding gives, have a null text. Rows with
    one doc_id each get a row, very long lists are decoded whole, and an empty table gives no rows."""
    ship(encoded.sparkSession)
    schema = "doc_id long, n_pieces long, ids_crc32 long, text string"
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(_decode(model or default_model()), schema)
