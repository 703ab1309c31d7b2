"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of those of its hashed features, which are the word and its beginnings, over the
root of their number. Filters of several widths run over the words of the whole text, and of each filter the
largest activations are kept (max pooling, of the POOL largest). A logistic layer scores them. The threshold is
calibrated for each language, which naive Bayes over the same features reads off the text; a score is shifted so
that its language's threshold is 0.5.

The model learns from all labelled rows. Spark sums their features' counts, which give the log odds and naive Bayes;
deals the rows into blocks, a task each, that train the network on their own rows, starting from the same one; averages
what they make of it, for ROUNDS rounds; and counts the calibration rows by logit. The driver holds the model and these
sums, whose size depends on the features alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.langid import _BETWEEN, held_out, words_of
from graphloom.llm.runtime import numbers, packed, saved, ship, trim, worker
from graphloom.llm.words import U, Words, chunks, span_hashes
from graphloom.operators.frames import FEW_ROWS

#: Beginnings of words that are features, in bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
BITS = 20
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
POOL = 3
#: Bytes of text that are scored at once, and words of a longer text.
CHUNK = 1 << 19
WINDOW = 1 << 17
#: Fewer calibration rows of either label than this, and a language has the threshold of all.
FEW = 5
#: Labelled rows that a task trains on, about, and those it holds at once; how often the tasks' networks are averaged.
BLOCK = 32_768
PIECE = 4096
ROUNDS = 2
#: Steps of Adam at least, over all rounds, and documents with a feature without which it isn't learned.
STEPS = 160
LEAST = 4
SEED = 5
#: Parts of one by which averaged numbers are summed, so that sums don't depend on their order, and by which logits are counted.
FINE = 1 << 24
NOTCHES = 1 << 10
#: Rows of the network that a task sends at once.
SLICE = 1024
_SHIFTS = [(w, j) for w in WIDTHS for j in range(w)]


class Model(NamedTuple):
    place: np.ndarray  # of each bucket: its row in `embeddings`, 0 for none
    embeddings: np.ndarray  # row 0 is zero
    filters: np.ndarray  # one block of FILTERS columns for each of _SHIFTS
    bias: np.ndarray
    top: np.ndarray  # weights of the pooled activations
    rest: float
    languages: np.ndarray  # log likelihood of each row of `embeddings` in each language; column 0: any other
    thresholds: np.ndarray  # logits, of each language


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every feature of the words, sorted by word."""
    size, each = ends - starts, np.arange(len(starts))
    words, buckets = [each], [span_hashes(data, starts, ends, 71) >> U(64 - BITS)]
    for n in BEGINNINGS:
        long = np.flatnonzero(size > n)
        words.append(long)
        buckets.append(span_hashes(data, starts[long], starts[long] + n, 71 + n) >> U(64 - BITS))
    words, buckets = np.concatenate(words), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(words, kind="stable")
    return words[order], buckets[order]


def _lower(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), _BETWEEN, " ")


def _summed(rows: np.ndarray, words: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """Of each of n words the sum of the table's rows of its features; words is sorted and has each word."""
    return np.add.reduceat(table[rows], np.searchsorted(words, np.arange(n)), axis=0) if n else np.zeros((0, table.shape[1]), table.dtype)


def activations(parts: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Of each word of a run, what all filters that begin there give; parts: what each word adds in each place of a filter.

    A filter that reaches beyond the last word meets zeros there.
    """
    n, out = len(parts), np.empty((len(parts), len(bias)), parts.dtype)
    for i, w in enumerate(WIDTHS):
        own = out[:, i * FILTERS : (i + 1) * FILTERS]
        own[:] = bias[i * FILTERS : (i + 1) * FILTERS]
        for j in range(w):
            at = _SHIFTS.index((w, j)) * FILTERS
            own[: max(0, n - j)] += parts[j:, at : at + FILTERS]
    return out


def pooled(values: np.ndarray) -> np.ndarray:
    """The POOL largest activations of each filter, falling, 0 at least; (filters, POOL)."""
    n, k = values.shape
    if n > POOL:
        values = np.partition(values, n - POOL, axis=0)[n - POOL :]
    best = np.zeros((POOL, k), values.dtype)
    best[: min(n, POOL)] = -np.sort(-values, axis=0)
    return np.maximum(best, 0).T


class _Texts:
    """The words of some texts as numbers, and the features of the distinct words."""

    def __init__(self, texts: pa.Array) -> None:
        self.documents: list[np.ndarray] = []
        seen: dict[int, int] = {}
        owner, bucket = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at, end, data, offsets in chunks(_lower(texts)):
            w = words_of(data, offsets)
            distinct, example, which = np.unique(w.hashes(43), return_index=True, return_inverse=True)
            known = len(seen)
            ids = np.array([seen.setdefault(h, len(seen)) for h in distinct.tolist()], np.int64)
            fresh = example[ids >= known]
            a, b = word_features(data, w.starts[fresh], w.ends[fresh])
            owner.append(ids[ids >= known][a] if len(fresh) else a)
            bucket.append(b)
            ids = ids[which] if len(w) else np.zeros(0, np.int64)
            self.documents += [ids[w.first[i] : w.first[i + 1]] for i in range(end - at)]
        self.n_words = len(seen)
        owner, bucket = np.concatenate(owner), np.concatenate(bucket)
        order = np.argsort(owner, kind="stable")
        self.owner, self.bucket = owner[order], bucket[order]
        self.first = np.searchsorted(self.owner, np.arange(self.n_words + 1))

    def runs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the words, place in `bucket`) of every feature of these words."""
        count = self.first[words + 1] - self.first[words]
        return np.repeat(np.arange(len(words)), count), np.repeat(self.first[words] - np.cumsum(count) + count, count) + np.arange(count.sum())

    def counts(self, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, how many of the documents have it, how many of their words) of all features in some documents."""
        ids = np.concatenate([np.zeros(0, np.int64), *(self.documents[i] for i in documents)])
        of = np.repeat(np.arange(len(documents)), [len(self.documents[i]) for i in documents])
        pairs, many = np.unique(of * max(1, self.n_words) + ids, return_counts=True)
        each, at = self.runs(pairs % max(1, self.n_words))
        buckets, which = np.unique(self.bucket[at], return_inverse=True)
        held = np.unique(which * max(1, len(documents)) + pairs[each] // max(1, self.n_words)) // max(1, len(documents))
        return buckets, np.bincount(held, minlength=len(buckets)), np.bincount(which, many[each], len(buckets)).astype(np.int64)

    def placed(self, place: np.ndarray) -> None:
        self.rows = place[self.bucket].astype(np.int64)
        self.scale = _scale(self.owner, self.rows, self.n_words)


def _scale(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """One over the root of how many known features each word has."""
    return 1 / np.sqrt(np.maximum(np.bincount(owner, rows > 0, n), 1)).astype(np.float32)


def _start(buckets: np.ndarray, seen: np.ndarray, learned: np.ndarray, by_language: np.ndarray, others: bool, rng: np.random.Generator) -> Model:
    """The untrained network, and naive Bayes.

    buckets: those that are features. seen: how many rows to learn from have them, clean ones and toxic ones, of `learned` rows in
    all. by_language: how many words have them in each language, column 0: in others, which count only if there are such.
    The first dimension of the embeddings starts at the features' log odds, drawn to 0 for rare ones, which the first filter reads; all
    else starts at random.
    """
    size, wide = len(buckets) + 1, FILTERS * len(WIDTHS)
    place = np.zeros(1 << BITS, np.int32)
    place[buckets] = np.arange(1, size)
    E = rng.normal(0, 0.3, (size, DIMENSIONS)).astype(np.float32)
    W = rng.normal(0, 0.3, (DIMENSIONS, FILTERS * len(_SHIFTS))).astype(np.float32)
    top = rng.normal(0, 0.2, (wide, POOL)).astype(np.float32)
    if learned.sum():
        share = (seen + 2) / (learned + 4)[:, None]
        E[1:, 0] = np.log(share[1] / share[0])
        W[0, 0], top[0] = 1.0, 0.3
    E[0] = 0
    counts = np.concatenate([np.full((1, by_language.shape[1]), 0.5), by_language + 0.5])
    likely = np.log(counts / counts.sum(0)).astype(np.float32)
    if not others:
        likely[:, 0] = -1e9
    likely[0] = 0
    return Model(place, E, W, np.zeros(wide, np.float32), top, 0.0, likely, np.zeros(by_language.shape[1]))


def _learn(model: Model, texts: _Texts, toxic: np.ndarray, balance: float, steps: int, rng: np.random.Generator, batch: int = 32) -> tuple[np.ndarray, list[np.ndarray]]:
    """`steps` steps of Adam, or the whole epoch that holds the last, on all of some texts: (rows of the embeddings that were pulled, [these
    rows, filters, bias, top, rest]). Clean rows weigh `balance`.
    """
    texts.placed(model.place)
    used, rows_of = np.unique(np.concatenate([[0], texts.rows]), return_inverse=True)
    rows_of, first, scale = rows_of[1:], texts.first, texts.scale
    E, wide = model.embeddings[used], len(model.bias)
    params = [E, model.filters.copy(), model.bias.copy(), model.top.copy(), np.full(1, model.rest, np.float32)]
    W, bias, top, rest = params[1:]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    lately = np.zeros(len(used), np.int64)  # the step at which each embedding was last pulled
    toxic = np.asarray(toxic, np.float32)
    weight = np.where(toxic > 0, 1, balance).astype(np.float32)
    t = 0
    while t < steps and len(toxic) and texts.n_words:
        order = rng.permutation(len(toxic))
        for lo in range(0, len(order), batch):
            part, t = order[lo : lo + batch], t + 1
            distinct, which = np.unique(np.concatenate([texts.documents[i] for i in part]), return_inverse=True)
            owner, runs = texts.runs(distinct)
            rows = rows_of[runs]
            x = _summed(rows, owner, E, len(distinct)) * scale[distinct][:, None]
            projected, at = x @ W, 0
            slopes = [np.zeros(0, np.float32), *(np.zeros_like(p) for p in params[1:])]
            best = np.zeros((len(part), POOL, wide), np.float32)  # activations, where in the batch, and where each text ends
            place, end = np.zeros((len(part), POOL, wide), np.int64), np.zeros(len(part), np.int64)
            for row, i in enumerate(part):
                m = len(texts.documents[i])
                act, k = activations(projected[which[at : at + m]], bias), min(POOL, m)
                if m:
                    who = np.argpartition(act, m - k, axis=0)[m - k :]
                    place[row, :k], best[row, :k] = who + at, np.take_along_axis(act, who, 0)
                at += m
                end[row] = at
            rank = np.argsort(-best, axis=1, kind="stable")
            place, best = np.take_along_axis(place, rank, 1), np.maximum(np.take_along_axis(best, rank, 1), 0)
            z = best.transpose(0, 2, 1)
            p = 1 / (1 + np.exp(-np.clip(np.einsum("nfk,fk->n", z, top) + rest[0], -30, 30)))
            g = ((p - toxic[part]) * weight[part] / len(part)).astype(np.float32)
            slopes[3] += np.einsum("n,nfk->fk", g, z)
            slopes[4] += g.sum()
            back = g[:, None, None] * top.T * (best > 0)
            slopes[2] += back.sum((0, 1))
            hit_word, hit_column, hit_value = [], [], []
            for s, (w, j) in enumerate(_SHIFTS):
                cols = slice(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
                there, value = place[:, :, cols] + j, back[:, :, cols]
                on = (there < end[:, None, None]) & (value != 0)
                hit_word.append(which[there[on]])
                hit_column.append(s * FILTERS + np.nonzero(on)[2])
                hit_value.append(value[on])
            word, column, value = (np.concatenate(h) for h in (hit_word, hit_column, hit_value))
            pull = np.zeros((len(distinct), W.shape[1]), np.float32)
            np.add.at(pull, (word, column), value)
            slopes[1] += x.T @ pull
            dx = (pull @ W.T) * scale[distinct][:, None]
            hit = pull.any(axis=1)
            some = (rows > 0) & hit[owner]
            touched, inverse = np.unique(rows[some], return_inverse=True)
            slopes[0] = np.stack([np.bincount(inverse, dx[owner[some], d], len(touched)) for d in range(DIMENSIONS)], 1).astype(np.float32)
            for i, g in enumerate(slopes):  # moments of an embedding fade only when it is pulled
                at, (m1, m2) = touched if i == 0 else slice(None), moments[i]
                lately[touched] += i == 0
                n_steps = lately[touched][:, None] if i == 0 else t
                g = g + 1e-5 * params[i][at]
                m1[at] += 0.1 * (g - m1[at])
                m2[at] += 0.01 * (g * g - m2[at])
                params[i][at] -= 0.02 * (m1[at] / (1 - 0.9**n_steps)) / (np.sqrt(m2[at] / (1 - 0.99**n_steps)) + 1e-8)
    pulled = np.flatnonzero(lately)
    return used[pulled], [E[pulled], W, bias, top, rest]


def fit(texts: list[str], toxic: np.ndarray, languages: list[str | None], weights: np.ndarray, steps: int = STEPS, least: int = LEAST, batch: int = 32, seed: int = SEED) -> Model:
    """The model of some texts on one machine, as `train` makes it in a single block; weights: for how many rows each counts in the thresholds.

    It learns on three quarters of the rows, and takes the thresholds from the rest.
    """
    read, rng, toxic = _Texts(pa.array(texts, pa.large_string())), np.random.default_rng(seed), np.asarray(toxic)
    held = np.zeros(len(texts), bool)
    for label in (0, 1):  # every fourth row of each label, in random order, is for calibration
        rows = rng.permutation(np.flatnonzero(toxic == label))
        held[rows[: len(rows) // 4]] = True
    names = sorted({x for x in languages if x is not None})
    every, seen, by_language = np.zeros(1 << BITS, np.int64), np.zeros((2, 1 << BITS)), np.zeros((1 << BITS, len(names) + 1))
    for label in (0, 1):
        for on in (held, ~held):
            for name in {*languages}:
                some = np.flatnonzero((toxic == label) & on & np.array([x == name for x in languages]))
                buckets, documents, words = read.counts(some)
                every[buckets] += documents
                seen[label, buckets] += documents * (on is not held)
                if name is not None:
                    by_language[buckets, names.index(name) + 1] += words
    kept, learned = np.flatnonzero(every >= least), np.flatnonzero(~held)
    of_label = np.bincount(toxic[learned], minlength=2)
    model = _start(kept, seen[:, kept], of_label, by_language[kept], False, rng)
    own = _Texts(pa.array([texts[i] for i in learned], pa.large_string()))
    pulled, (E, W, bias, top, rest) = _learn(model, own, toxic[learned], of_label[1] / max(1, of_label[0]), steps, rng, batch)
    model.embeddings[pulled] = E
    model = model._replace(filters=W, bias=bias, top=top, rest=float(rest[0]))
    rows = np.flatnonzero(held) if held.any() else np.arange(len(texts))
    values, guesses = logits(model, pa.array([texts[i] for i in rows], pa.large_string()))
    return model._replace(thresholds=thresholds(values, toxic[rows] > 0, guesses, np.asarray(weights)[rows], len(names) + 1))


def _language(likelihood: np.ndarray) -> int:
    """The likeliest language's column."""
    return int(likelihood.argmax())


def thresholds(logits: np.ndarray, toxic: np.ndarray, languages: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """For each language the logit in the middle of where the weight of the wrong side is least; 0: of all rows."""
    out = np.zeros(n)
    for lang in range(n):
        own = np.ones(len(logits), bool) if lang == 0 else languages == lang
        if min(weights[toxic & own].sum(), weights[~toxic & own].sum()) < (1 if lang == 0 else FEW):
            out[lang] = out[0]
            continue
        order = np.argsort(logits[own], kind="stable")
        x, hit, w = logits[own][order], toxic[own][order], weights[own][order]
        missed = np.concatenate([[0], np.cumsum(w * hit)])  # toxic ones below the cut
        wrong = missed + np.concatenate([np.cumsum((w * ~hit)[::-1])[::-1], [0]])
        cuts = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
        possible = np.concatenate([[True], x[1:] > x[:-1], [True]])
        best = np.flatnonzero(possible & (wrong <= wrong[possible].min() + 1e-9))
        out[lang] = cuts[best[len(best) // 2]]
    return out


def _unpacked(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    unpress = zstandard.ZstdDecompressor()
    return pa.array([unpress.decompress(z).decode() for z in column.to_pylist()], pa.large_string())


@worker("toxicity")
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, lang, role, documents, words); role: 0 and 1 for rows to learn from by label, 2 for calibration rows."""
    for batch in batches:
        texts, langs = _Texts(_unpacked(batch["z"])), batch["lang"].to_pylist()
        roles = np.where(numbers(batch["held"]).astype(bool), 2, numbers(batch["toxic"]))
        groups: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(langs, roles.tolist())):
            groups.setdefault(key, []).append(i)
        for (lang, role), own in groups.items():
            buckets, documents, words = texts.counts(np.array(own))
            n = len(buckets)
            columns = [pa.array(buckets.astype(np.int32)), pa.array([lang] * n, pa.string()), pa.array(np.full(n, role, np.int32)), pa.array(documents), pa.array(words)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "lang", "role", "documents", "words"])


#: Names of the columns in which numbers of the network are averaged, DIMENSIONS of them a row.
_VALUES = [f"v{i}" for i in range(DIMENSIONS)]


def _fine(values: np.ndarray) -> np.ndarray:
    return np.rint(values.astype(np.float64) * FINE).astype(np.int64)


def _rest(model: Model) -> np.ndarray:
    """All of the network but its embeddings, DIMENSIONS numbers a row; row -1 comes first."""
    whole = np.concatenate([model.filters.ravel(), model.bias, model.top.ravel(), [model.rest]])
    return np.concatenate([whole, np.zeros(-len(whole) % DIMENSIONS)]).reshape(-1, DIMENSIONS)


def _taught(shared: Broadcast, balance: float, steps: int, turn: int):
    """What a task's rows change in the model: DIMENSIONS numbers of each embedding pulled, from row 1, and of all else in rows below 0.

    A row that leaves the task holds SLICE of them at most, compressed (most embeddings are pulled once or twice, by steps of one size). Rows are learned in pieces, each for `steps` steps or the whole epoch that holds the last.
    """

    @worker("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rng, pulled = shared.value, np.random.default_rng([SEED, turn, TaskContext.get().partitionId()]), []
        embeddings = now.embeddings.copy()
        now = now._replace(embeddings=embeddings)
        for piece in _pieces(batches):
            rows, (E, W, bias, top, rest) = _learn(now, _Texts(_unpacked(piece["z"])), numbers(piece["toxic"]), balance, steps, rng)
            embeddings[rows] = E
            pulled.append(rows)
            now = now._replace(filters=W, bias=bias, top=top, rest=float(rest[0]))
        if not pulled:
            return
        rows = np.unique(np.concatenate(pulled))
        moved = np.concatenate([_fine(_rest(now))[::-1] - _fine(_rest(shared.value))[::-1], _fine(embeddings[rows]) - _fine(shared.value.embeddings[rows])])
        rows = np.concatenate([np.arange(-len(_rest(now)), 0), rows])
        press = zstandard.ZstdCompressor(3)
        cuts = np.flatnonzero(np.diff(rows // SLICE, prepend=rows[0] // SLICE - 1, append=rows[-1] // SLICE + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            # numbers that lie near each other stand together, byte by byte
            z = press.compress(np.ascontiguousarray(moved[a:b].T).view(np.uint8).reshape(-1, 8).T.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([rows[a] // SLICE], pa.int32()), pa.array([press.compress(rows[a:b].tobytes())]), pa.array([z])], ["slice", "rows", "z"])

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of PIECE rows or some more; the last may have fewer."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= PIECE:
            yield pa.Table.from_batches(held)
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held)


def _means(shared: Broadcast):
    """Of what tasks changed in a slice of the model: (row, the means of what they made of it). A row's is that of the tasks that send it."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, unpress = key[0].as_py() * SLICE, zstandard.ZstdDecompressor()
        moved, many = np.zeros((SLICE, DIMENSIONS), np.int64), np.zeros(SLICE, np.int64)
        for batch in batches:
            for rows, z in zip(batch["rows"].to_pylist(), batch["z"].to_pylist()):
                at = np.frombuffer(unpress.decompress(rows), np.int64) - lo
                parts = np.frombuffer(unpress.decompress(z), np.uint8).reshape(8, -1).T
                moved[at] += np.ascontiguousarray(parts).view(np.int64).reshape(DIMENSIONS, -1).T
                many[at] += 1
        rows = np.flatnonzero(many)
        model = shared.value
        before = _fine(model.embeddings[rows + lo] if lo >= 0 else _rest(model)[-1 - (rows + lo)])
        means = ((before * many[rows, None] + moved[rows]) / many[rows, None] / FINE).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array((rows + lo).astype(np.int32)), *(pa.array(np.ascontiguousarray(v)) for v in means.T)], ["row", *_VALUES])

    return run


def _averaged(model: Model, taught: pa.Table) -> Model:
    """The model with the means of what blocks made of it; an embedding's is that of the blocks that pulled it."""
    rows = numbers(taught["row"])
    values = np.stack([numbers(taught[v]) for v in _VALUES], 1)
    embeddings = model.embeddings.copy()
    embeddings[rows[rows > 0]] = values[rows > 0]
    order = np.argsort(-rows[rows < 0])
    whole, at, parts = values[rows < 0][order].ravel(), 0, []
    for part in (model.filters, model.bias, model.top):
        parts.append(whole[at : at + part.size].reshape(part.shape))
        at += part.size
    return model._replace(embeddings=embeddings, filters=parts[0], bias=parts[1], top=parts[2], rest=float(whole[at]))


def _notched(shared: Broadcast):
    """Rows (language, notch, toxic): the language that each row's text is taken for, and its logit in NOTCHES parts of one."""

    @worker("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, lang = logits(shared.value, _unpacked(batch["z"]))
            notch = np.rint(np.clip(value, -500, 500) * NOTCHES).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(notch), batch["toxic"]], ["language", "notch", "toxic"])

    return run


def train(docs: DataFrame, labels: DataFrame, per_label: int | None = None) -> Model:
    """Fits to the whole texts of all labelled rows that aren't held out; with per_label, of as many ids of each label, those with the smallest hashes.

    Rows without an id, a text or a label of 0 or 1 don't count; of an id with both labels, neither. About a quarter of each label's rows,
    those with the smallest hashes of their ids, is for the thresholds, and the network doesn't learn from it. A language has
    a column of its own in naive Bayes if it has FEW of these rows of each label; the others share one, with the threshold of all.
    """
    ship(docs.sparkSession)
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
    ids = ids.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).filter("toxic = other").drop("other")
    if per_label is not None:
        order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_label).drop("n")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    rows = rows.filter("doc_id is not null and text is not null").filter(~held_out())
    ids = saved(ids)
    # many ids are joined by shuffle, for which texts are packed first
    rows = saved(packed(rows.join(F.broadcast(ids), "doc_id")) if ids.count() <= FEW_ROWS else packed(rows).join(ids.hint("merge"), "doc_id"))

    salted = F.xxhash64("doc_id", F.lit("calibration"))
    bars = {r[0]: r[1] for r in rows.groupBy("toxic").agg(F.percentile_approx(salted, 0.25)).collect()}
    rows = rows.withColumn("held", salted < F.when(F.col("toxic") == 1, bars.get(1)).otherwise(bars.get(0)).cast("long"))
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("toxic", "held").count().collect()}
    learned = np.array([sizes.get((label, False), 0) for label in (0, 1)])
    by_lang = rows.filter("held and lang is not null").groupBy("lang").agg(F.sum("toxic").alias("n"), F.count("*").alias("total"))
    names = sorted(r[0] for r in by_lang.filter((F.col("n") >= FEW) & (F.col("total") - F.col("n") >= FEW)).select("lang").collect())

    counts = rows.select("toxic", "held", "lang", "z").mapInArrow(_counts, "bucket int, lang string, role int, documents long, words long")
    own = [F.sum(F.when(F.col("lang") == name, F.col("words")).otherwise(0)).alias(f"l{i}") for i, name in enumerate(names, 1)]
    other = F.sum(F.when(F.col("lang").isNotNull() & ~F.col("lang").isin(names), F.col("words")).otherwise(0)).alias("l0")
    seen = [F.sum(F.when(F.col("role") == label, F.col("documents")).otherwise(0)).alias(f"s{label}") for label in (0, 1)]
    counts = counts.groupBy("bucket").agg(F.sum("documents").alias("documents"), *seen, other, *own)
    table = counts.filter(F.col("documents") >= LEAST).drop("documents").toArrow().sort_by("bucket")
    by_language = np.stack([numbers(table[f"l{i}"]) for i in range(len(names) + 1)], 1)
    model = _start(numbers(table["bucket"]), np.stack([numbers(table["s0"]), numbers(table["s1"])]), learned, by_language, bool(by_language[:, 0].any()), np.random.default_rng(SEED))

    del table, by_language
    trim()
    total, context = int(learned.sum()), docs.sparkSession.sparkContext
    if not total:
        return model
    blocks = -(-total // BLOCK)
    steps = -(-STEPS // (ROUNDS * -(-min(total, BLOCK) // PIECE)))
    for turn in range(ROUNDS):
        shared = context.broadcast(model._replace(languages=model.languages[:0]))
        teach = _taught(shared, float(learned[1] / max(1, learned[0])), steps, turn)
        taught = rows.filter("not held").select("toxic", "z").coalesce(blocks).mapInArrow(teach, "slice int, rows binary, z binary")
        taught = taught.groupBy("slice").applyInArrow(_means(shared), "row int, " + ", ".join(f"{v} float" for v in _VALUES))
        model = _averaged(model, taught.toArrow())
        shared.destroy()
        trim()
    # without a row of each label for the thresholds, they are those of all rows
    known = rows.filter("held") if sizes.get((1, True)) and sizes.get((0, True)) else rows
    shared = context.broadcast(model)
    found = known.select("toxic", "z").mapInArrow(_notched(shared), "language int, notch int, toxic int").groupBy("language", "notch", "toxic").agg(F.count("*").alias("n")).toArrow()
    shared.destroy()
    found = found.sort_by([("language", "ascending"), ("notch", "ascending"), ("toxic", "ascending")])
    return model._replace(thresholds=thresholds(numbers(found["notch"]) / NOTCHES, numbers(found["toxic"]) > 0, numbers(found["language"]), numbers(found["n"]), len(names) + 1))


def logits(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(logit, language's column) of each text, read whole; a text without a word has the logit of no activation, in language 0."""
    out, langs = np.full(len(texts), model.rest), np.zeros(len(texts), np.int64)
    wide = len(model.bias)
    for at, end, data, offsets in chunks(_lower(texts), CHUNK):
        words: Words = words_of(data, offsets)
        if not len(words):
            continue
        _, example, which = np.unique(words.hashes(43), return_index=True, return_inverse=True)
        owner, bucket = word_features(data, words.starts[example], words.ends[example])
        rows = model.place[bucket]
        x = _summed(rows, owner, model.embeddings, len(example)) * _scale(owner, rows, len(example))[:, None]
        projected, likely = x @ model.filters, _summed(rows, owner, model.languages, len(example))
        for i in range(end - at):
            lo, hi = int(words.first[i]), int(words.first[i + 1])
            if lo == hi:
                continue
            likelihood, best = np.zeros(likely.shape[1]), np.zeros((wide, 0), np.float32)
            for a in range(lo, hi, WINDOW):  # a long text in runs, each with what its last filters reach into
                b = min(hi, a + WINDOW)
                likelihood += likely[which[a:b]].sum(0)
                reach = projected[which[a : min(hi, b + max(WIDTHS) - 1)]]
                best = np.concatenate([best, pooled(activations(reach, model.bias)[: b - a])], axis=1)
            best = -np.sort(-best, axis=1)[:, :POOL]
            out[at + i] = float((best * model.top).sum()) + model.rest
            langs[at + i] = _language(likelihood)
    return out, langs


def _score(model: Model):
    @worker("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, lang = logits(model, batch["text"])
            score = 1 / (1 + np.exp(-np.clip(value - model.thresholds[lang], -500, 500)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None) -> DataFrame:
    """Out, a row for each row of docs: doc_id, held_out, score from 0 to 1, predicted (1 from 0.5 on).

    Scores read the text alone, whole. Null and empty texts, and those without a letter, get the score of a text without any
    activation. Rows may share a doc_id or have none (not held out, never learned from). labels(doc_id, toxic) needn't
    cover all rows; without one usable row of each label the model is untrained and its scores say nothing. An empty
    table gives no rows; other columns don't matter.
    """
    ship(docs.sparkSession)
    model = model or train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
