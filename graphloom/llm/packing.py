"""Tokenising and bulk-synchronous best-fit packing.

Sizes and gaps are whole numbers up to the capacity, so all documents of one size are one run, and so are
sequences that were filled alike; a run is a row (size or gap, how many, its first rank or sequence), and
there are some thousands of them, whatever the corpus. Packing goes in rounds over the table of runs:

1. Documents and gaps are sorted by size into ranges. Each range is swept from its largest size down: a
   document takes its successor, the smallest gap that holds it and that no larger one, nor one of lower
   rank, has taken; a run of documents fills each gap with as many as it holds.
2. What is left of two neighbouring ranges is swept together, then of four, until one sweep joins all.
3. Documents larger than every gap open sequences, the largest first, no more than what is left would fill.
   What is left of the gaps that were filled goes into the next round, with the documents that found none.

Each round is written to the shared folder. Documents of just the capacity are sequences of their own.
The place of every other document follows from its rank among those of its size.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.runtime import MEMORIES, numbers, saved, ship, worker
from graphloom.llm.words import SPACED, Words, chunks

#: 1 for ASCII letters, 2 for marks between which and letters the tokenizer always splits.
_KINDS = np.zeros(256, np.int8)
_KINDS[[*range(65, 91), *range(97, 123)]] = 1
_KINDS[list(b',.;:!?()"-')] = 2
#: Distinct words whose ids a worker remembers (about 50 MB); beyond that it starts afresh.
REMEMBERED = 1_500_000
#: Ranges of sizes that are swept side by side, a power of two.
RANGES = 4
#: Kinds of runs: documents, gaps, documents that have a place, and gaps that the next round offers.
DOCUMENTS, GAPS, PLACED, LATER = range(4)
#: value: size or gap; n: how many documents or sequences; at: the first rank or sequence. Of PLACED ones: the
#: first sequence, how many go to each, the offset of the first, and how many sequences they opened.
RUN = ["kind", "value", "n", "at", "first", "each", "offset", "opened"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids by word. The tokenizer splits at white space and between ASCII letters and plain marks, so a
    text's ids are those of the parts between such places in a row."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)  # tokens that end a word
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """hashes: sorted, new."""
        counts, ids = np.zeros(len(words), np.int64), []
        plain = np.array([w.isalpha() and (w.isascii() or unicodedata.normalize("NFC", w).lower().isalpha()) for w in words], bool)
        # letters alone stay one word of the tokenizer, so many are encoded as one text
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        for at in range(0, int(plain.sum()), 2048):
            some = order[at : min(at + 2048, plain.sum())]
            got = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in some])], add_special_tokens=False)[0]
            ids.append(np.array(got.ids, np.uint32))
            counts[some] = np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1)
        rest = order[int(plain.sum()) :]
        for at in range(0, len(rest), 2048):
            some = rest[at : at + 2048]
            for i, got in zip(some, self.tokenizer.encode_batch_fast([words[i] for i in some], add_special_tokens=False)):
                ids.append(np.array(got.ids, np.uint32))
                counts[i] = len(got.ids)
        sizes = counts[order]
        start = np.empty_like(counts)
        start[order] = len(self.ids) + np.cumsum(sizes) - sizes
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.start, self.count = np.insert(self.start, place, start), np.insert(self.count, place, counts)
        self.ids = np.concatenate([self.ids, *ids])

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, the number of ids of each text)."""
        words = Words(data, offsets, SPACED, _KINDS)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        distinct, example, which = np.unique(words.hashes(17), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            if len(self.known) + new.sum() > REMEMBERED:
                self.clear()
                new[:] = True
            raw = data.tobytes()
            self.learn(distinct[new], [raw[words.starts[i] : words.ends[i]].decode() for i in example[new]])
            place = np.searchsorted(self.known, distinct)
        start, count = self.start[place][which], self.count[place][which]
        total = int(count.sum())
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)
        ends = np.concatenate([[0], np.cumsum(count)])[words.first]
        return self.ids[at], np.diff(ends)


_WORD_IDS: dict[str, WordIds] = {}
MEMORIES["packing"] = _WORD_IDS.clear


def _pieces(path: str, capacity: int, end_id: int):
    """Rows (doc_id, piece, start, length, ids_crc32)."""

    @worker("packing")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _WORD_IDS.get(path) or _WORD_IDS.setdefault(path, WordIds(path))
        for batch in batches:
            for at, end, data, offsets in chunks(batch["text"]):
                ids, counts = ids_of.of(data, offsets)
                ends = np.cumsum(counts)
                row, piece, start, length, crc = [], [], [], [], []
                for i, (hi, n) in enumerate(zip(ends.tolist(), counts.tolist())):
                    own = np.append(ids[hi - n : hi], np.uint32(end_id)).astype("<u4")
                    for p, lo in enumerate(range(0, n + 1, capacity)):
                        part = own[lo : lo + capacity]
                        row.append(at + i)
                        piece.append(p)
                        start.append(lo)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def sweep(runs: list[tuple[int, ...]], capacity: int, opening: int | None = None) -> list[tuple[int, ...]]:
    """Runs after a sweep from the largest size down; all kinds may come in, and PLACED and LATER ones pass.

    With opening, the next unused sequence, documents larger than all gaps that are left open sequences: all
    those of over half the capacity, and of the others the largest octave, no more than what is left needs.
    """
    out = [r for r in runs if r[0] in (PLACED, LATER)]
    gaps: list[list[int]] = []  # [gap, how many, first sequence], the smallest on top
    left: list[tuple[int, int, int]] = []

    def fill(size: int, n: int, rank: int, gap: int, first: int, opened: int) -> None:
        """n documents go to gaps from `first` on, the last of which may get fewer than it holds."""
        each = gap // size
        full, rest = divmod(n, each)
        out.append((PLACED, size, n, rank, first, each, capacity - gap, opened))
        for many, used, at in ((full, each, first), (min(rest, 1), rest, first + full)):
            if many and gap > used * size:
                out.append((LATER, gap - used * size, many, at, 0, 0, 0, 0))

    for kind, value, n, at, *_ in sorted((r for r in runs if r[0] in (DOCUMENTS, GAPS)), key=lambda r: (-r[1], -r[0], r[3])):
        if kind == GAPS:
            gaps.append([value, n, at])
            continue
        while n and gaps:
            gap, many, first = gaps[-1]
            each = gap // value
            some = min(n, many * each)
            used = -(-some // each)
            fill(value, some, at, gap, first, 0)
            gaps[-1][1:] = [many - used, first + used]
            if many == used:
                gaps.pop()
            n, at = n - some, at + some
        if n:
            left.append((value, n, at))
    if opening is not None and left:
        largest = max([g for g, *_ in gaps] + [r[1] for r in out if r[0] == LATER], default=0)
        need = sum(size * n for size, n, _ in left) - sum(r[1] * r[2] for r in out if r[0] == LATER)
        need, waiting = max(1, -(-need // capacity)), []
        for size, n, rank in left:
            each, some = capacity // size, 0
            if size > largest and (each == 1 or need > 0 and 2 * size > left[0][0]):
                opened = -(-n // each) if each == 1 else min(-(-n // each), need)
                some, need = min(n, opened * each), need - opened
                fill(size, some, rank, capacity, opening, opened)
                opening += opened
            if some < n:
                waiting.append((size, n - some, rank + some))
        left = waiting
    out += [(DOCUMENTS, size, n, at, 0, 0, 0, 0) for size, n, at in left]
    return out + [(GAPS, gap, many, first, 0, 0, 0, 0) for gap, many, first in gaps]


def _swept(capacity: int, opening: int | None):
    def run(table: pa.Table) -> pa.Table:
        rows = sweep(list(zip(*(table[c].to_pylist() for c in RUN))), capacity, opening)
        columns = list(zip(*rows)) if rows else [()] * len(RUN)
        columns.append([max(0, r[1] - 1) * RANGES // capacity for r in rows])
        return pa.table({c: pa.array(list(v), pa.int64()) for c, v in zip([*RUN, "range"], columns)})

    return run


def packing_plan(runs: DataFrame, capacity: int) -> tuple[np.ndarray, int]:
    """(plan, number of sequences) for runs (length, count) of lengths below the capacity, by rounds of sweeps.

    plan: rows (size, rank, sequence, each, offset): from this rank on, documents of this size go to this and the following
    sequences, `each` of them to one, the first of them at this offset. It has some thousand rows a round.
    """
    schema = ", ".join(f"{c} long" for c in [*RUN, "range"])
    zero = F.lit(0).cast("long")
    columns = {"kind": F.lit(DOCUMENTS).cast("long"), "value": F.col("length"), "n": F.col("count")}
    state = runs.select(*(columns.get(c, zero).alias(c) for c in RUN))
    state = saved(state.withColumn("range", F.floor((F.col("value") - 1) * RANGES / capacity)))
    sequences, rounds = 0, []
    left = state.agg(F.sum("n")).first()[0]
    while left:
        kind = F.when(F.col("kind") == LATER, F.lit(GAPS).cast("long")).otherwise(F.col("kind"))
        state = state.filter(F.col("kind") != PLACED).withColumn("kind", kind)
        for level in range(RANGES.bit_length()):
            last = 1 << level == RANGES
            together = F.floor(F.col("range") / (1 << level)).alias("together")
            state = state.groupBy(together).applyInArrow(_swept(capacity, sequences if last else None), schema)
        state = saved(state)
        rounds.append(state)
        left, opened = state.agg(F.coalesce(F.sum(F.when(F.col("kind") == DOCUMENTS, F.col("n"))), F.lit(0)), F.sum("opened")).first()
        sequences += opened
    rows = [r for x in rounds for r in x.filter(F.col("kind") == PLACED).select("value", "at", "first", "each", "offset").collect()]
    return np.array(sorted(map(tuple, rows)), np.int64).reshape(-1, 5), sequences


def _placed(plan: np.ndarray):
    """Adds sequence_id and offset to rows with length and rank; rows without a rank are sequences of their own."""
    keys = plan[:, 0] << 48 | plan[:, 1]

    @worker("packing")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank, uid = (numbers(batch[c]) for c in ("length", "rank", "uid"))
            sequence, offset = -1 - uid, np.zeros(len(uid), np.int64)
            some = np.flatnonzero(rank >= 0)
            row = np.searchsorted(keys, size[some] << 48 | rank[some], "right") - 1
            _, base, first, each, at = plan[row].T
            nth = rank[some] - base
            sequence[some], offset[some] = first + nth // each, at + nth % each * size[some]
            out = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Packs all documents into sequences of at most `capacity` tokens, by rounds of best-fit sweeps.

    Out, a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A
    document's ids are the tokenizer's and end_id; one of over `capacity` ids is cut into pieces
    of just so many, the last maybe shorter. Offsets have no gaps. Sequences of one full piece have negative
    numbers, the others are numbered from 0.

    A null or empty text is the end_id alone. Rows may share a doc_id or have none; each row's pieces
    are placed. Very long texts are handled whole. An empty table gives no rows. Other columns
    of docs don't matter.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = docs.mapInArrow(_pieces(tokenizer or default_tokenizer(), capacity, end_id), schema)
    # numbered as they are written, by partition and place in it, so that a rank is the same in every evaluation
    pieces = saved(pieces.withColumn("uid", F.monotonically_increasing_id()))
    short = pieces.filter(F.col("length") < capacity).withColumn("part", F.shiftright("uid", 33))
    plan, _ = packing_plan(short.groupBy("length").count(), capacity)
    # ranks within a size: of each partition, then within the partition
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = short.groupBy("length", "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "part").orderBy("uid")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "uid"]
    ranked = short.join(parts, ["length", "part"]).select(*columns, (F.col("base") + F.row_number().over(within) - 1).cast("long").alias("rank"))
    full = pieces.filter(F.col("length") == capacity).select(*columns, F.lit(-1).cast("long").alias("rank"))
    return ranked.unionByName(full).mapInArrow(_placed(plan), f"{schema}, sequence_id long, offset long")
