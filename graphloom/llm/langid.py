"""Language ID by a linear-chain conditional random field over words.

Each word has affix, character n-gram and lexicon features; learned transitions tie neighbouring
words, and forward-backward gives every word a distribution over languages, so that code-switched
text is labelled in runs. A document's language is the one with the largest mean marginal.

The field is fitted here, by a task, to a bounded sample of labelled rows. Fragments of sampled
documents are strung together into sequences that switch languages, from which the transitions are learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.runtime import ship, worker
from graphloom.llm.words import U, Words, chunks, class_table, constants, mix

#: Words are runs of ASCII letters and of bytes of other characters.
LETTERS = class_table(bytes(b for b in range(128) if not chr(b).isalpha()))
_ASCII_LETTER = LETTERS & (np.arange(256) < 128)
BITS = 16
ORDERS = (1, 2, 3, 4)
AFFIX = 5
#: Longer runs of letters, in bytes, such as text without spaces or encoded data, are cut into words of so many.
WORD_BYTES = 48
#: What isn't ASCII and neither a letter nor a mark on one stands between words as a space does.
_BETWEEN = r"[^\p{L}\p{M}\x00-\x7F]+"
SEGMENT = 64
#: Words of the sample that a step of the fitting takes at once.
FIT_WORDS = 1 << 16
#: Bytes of text that are predicted at once.
CHUNK = 1 << 20


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of a run of texts, long ones in parts."""
    words = Words(data, offsets, LETTERS)
    parts = -(-(words.ends - words.starts) // WORD_BYTES)
    if len(words) and int(parts.max()) > 1:
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, ends = np.repeat(words.starts, parts) + nth * WORD_BYTES, np.repeat(words.ends, parts)
        words.first = np.concatenate([[0], np.cumsum(parts)])[words.first]
        words.starts, words.ends = starts, np.minimum(starts + WORD_BYTES, ends)
    return words


class Model(NamedTuple):
    labels: list[str]
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # log


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all words in a row, how many of each word)."""
    size = ends - starts
    total = size + 2
    first = np.cumsum(total) - total
    text = np.zeros(int(total.sum()), np.uint64)  # 0 marks both ends
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(first + 1, size) + step] = data[np.repeat(starts, size) + step]
    last = np.repeat(first + total, total)
    place, shift = np.arange(len(text)), U(64 - BITS)
    word = np.repeat(np.arange(len(size)), total)
    grams, words = [], []
    for n, salt in zip(ORDERS, constants(len(ORDERS), 47)):
        code = np.zeros(max(0, len(text) - n + 1), np.uint64)
        for j in range(n):
            code = code * U(257) + text[j : len(text) - n + 1 + j] + U(1)
        fits = place[: len(code)] + n <= last[: len(code)]
        grams.append(mix(code[fits] * salt) >> shift)
        words.append(word[: len(code)][fits])
    each = np.arange(len(size))
    for at, salt in zip((first, first + total - AFFIX), constants(2, 53)):
        long = total >= AFFIX
        code = np.zeros(long.sum(), np.uint64)
        for j in range(AFFIX):
            code = code * U(257) + text[at[long] + j] + U(1)
        grams.append(mix(code * salt) >> shift)
        words.append(each[long])
    grams.append(mix(hashes ^ U(59)) >> shift)  # the lexicon
    words.append(each)
    grams, words = np.concatenate(grams).astype(np.int64), np.concatenate(words)
    order = np.argsort(words, kind="stable")
    return grams[order], np.bincount(words, minlength=len(size))


def emissions(weights: np.ndarray, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log scores of each word's labels; every word has features."""
    if not len(counts):
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[features], np.cumsum(counts) - counts, axis=0) / np.sqrt(counts)[:, None]


def marginals(log_scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences at once: first holds where each begins, and the end of the last.

    Sequences are cut into segments. The transfer matrices of all segments are multiplied up side by
    side, messages pass from segment to segment, then run within all segments side by side.
    """
    n, k = log_scores.shape
    out = np.zeros((n, k))
    if not n:
        return out
    scores = np.exp(log_scores - log_scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    length = np.diff(first)
    parts = -(-length // SEGMENT)
    owner = np.repeat(np.arange(len(length)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[:-1][owner] + nth * SEGMENT
    size = np.minimum(SEGMENT, first[1:][owner] - begin)
    order = np.argsort(-size, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    begin, size = begin[order], size[order]
    active = [int(np.searchsorted(-size, -s, "left")) for s in range(int(size.max()))]  # segments longer than s
    transfer = np.tile(np.eye(k), (len(begin), 1, 1))
    for s, m in enumerate(active):
        t = (transfer[:m].reshape(-1, k) @ step).reshape(m, k, k) * scores[begin[:m] + s][:, None, :]
        transfer[:m] = t / t.max(axis=(1, 2), keepdims=True)
    into, behind = np.full((len(begin), k), 1.0 / k), np.ones((len(begin), k))
    by_parts = np.argsort(-parts, kind="stable")
    base = (np.cumsum(parts) - parts)[by_parts]
    sorted_parts = parts[by_parts]
    most = int(parts.max())
    for j in range(1, most):
        m = int(np.searchsorted(-sorted_parts, -j, "left"))
        before, here = place[base[:m] + j - 1], place[base[:m] + j]
        v = np.einsum("ij,ijk->ik", into[before], transfer[before])
        into[here] = v / v.sum(axis=1, keepdims=True)
    for j in range(most - 2, -1, -1):
        m = int(np.searchsorted(-sorted_parts, -(j + 1), "left"))
        after, here = place[base[:m] + j + 1], place[base[:m] + j]
        v = np.einsum("ijk,ik->ij", transfer[after], behind[after])
        behind[here] = v / v.sum(axis=1, keepdims=True)
    message = into
    for s, m in enumerate(active):
        v = (message[:m] @ step) * scores[begin[:m] + s]
        message[:m] = v / v.sum(axis=1, keepdims=True)
        out[begin[:m] + s] = message[:m]
    message = behind
    for s in range(len(active) - 1, -1, -1):
        m = active[s]
        at = begin[:m] + s
        out[at] *= message[:m]
        v = (scores[at] * message[:m]) @ step.T
        message[:m] = v / v.sum(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], rounds: int = 40, sequence: int = 200, seed: int = 3) -> Model:
    """The field that makes the labels of the sample's words likeliest, by Adam on the whole sample."""
    names = sorted(set(labels))
    data = pc.replace_substring_regex(pa.array([t.lower() for t in texts], pa.large_string()), _BETWEEN, " ")
    words, label, bags, counts = [], [], [], []
    seen: dict[int, int] = {}
    for at, end, raw, offsets in chunks(data):
        w = words_of(raw, offsets)
        if not len(w):
            continue
        distinct, example, which = np.unique(w.hashes(43), return_index=True, return_inverse=True)
        known = len(seen)
        numbers = np.array([seen.setdefault(h, len(seen)) for h in distinct.tolist()])
        fresh = numbers >= known
        bag, count = word_features(raw, w.starts[example[fresh]], w.ends[example[fresh]], distinct[fresh])
        bags.append(bag)
        counts.append(count)
        words.append(numbers[which])
        label.append(np.array([names.index(x) for x in labels[at:end]])[w.document()])
    if not words:
        return Model(names, np.zeros((1 << BITS, max(1, len(names)))), np.zeros((len(names), len(names))))
    words, label, bag, count = (np.concatenate(x) for x in (words, label, bags, counts))
    # fragments of 5 to 60 words in random order, cut into sequences that switch languages
    rng = np.random.default_rng(seed)
    cuts = np.cumsum(rng.integers(5, 61, len(words)))
    cuts = np.concatenate([[0], cuts[cuts < len(words)], [len(words)]])
    pieces = [np.arange(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    order = np.concatenate([pieces[i] for i in rng.permutation(len(pieces))])
    words, label = words[order], label[order]
    first = np.append(np.arange(0, len(words), sequence), len(words))
    k, n = len(names), len(words)
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    inner = np.flatnonzero(inner)
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (label[inner - 1], label[inner]), 1)
    weights, trans = np.zeros((1 << BITS, k)), np.zeros((k, k))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
    scale = 1 / np.sqrt(count)
    heads = np.cumsum(count) - count
    cuts = np.append(np.arange(0, len(first) - 1, max(1, FIT_WORDS // sequence)), len(first) - 1)
    batches = [(int(first[a]), int(first[b]), first[a : b + 1] - first[a]) for a, b in zip(cuts[:-1], cuts[1:])]
    for t in range(1, rounds + 1):
        slopes = [-1e-6 * weights, seen_pairs / n - 1e-4 * trans]
        for lo, hi, ends in batches:  # whole sequences, of which few are held at a time
            own, local = np.unique(words[lo:hi], return_inverse=True)
            runs = np.repeat(heads[own] - np.cumsum(count[own]) + count[own], count[own]) + np.arange(count[own].sum())
            p = marginals(emissions(weights, bag[runs], count[own])[local], ends, trans)
            # expected pairs from the marginals on both sides of each step, summed up without a table for each word
            after = np.ones(hi - lo, bool)
            after[ends[:-1]] = False
            after = np.flatnonzero(after)
            step = np.exp(trans)
            right = p[after] / np.maximum(p[after - 1] @ step, 1e-12)
            total = np.einsum("ij,ij->i", p[after - 1] @ step, right)
            slopes[1] -= step * ((p[after - 1] / total[:, None]).T @ right) / n
            p[np.arange(hi - lo), label[lo:hi]] -= 1
            by_word = np.stack([np.bincount(local, p[:, j], len(own)) for j in range(k)], 1) * scale[own, None]
            owner = np.repeat(np.arange(len(own)), count[own])
            for j in range(k):
                slopes[0][:, j] -= np.bincount(bag[runs], by_word[owner, j], 1 << BITS) / n
        for i, (x, g) in enumerate(zip((weights, trans), slopes)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            x += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.98**t)) + 1e-10)
    return Model(names, weights.astype(np.float32), trans)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("lang", pa.string())])


def _predict(model: Model, spans: bool, carried: tuple[str, ...] = ("doc_id", "held_out"), names: tuple[str, ...] = ("lang_pred", "score")):
    """Adds what `names` says to the carried columns: lang_pred, its score, and sure, the mean certainty of the words'
    languages, which is as high in text that switches between languages. The text is in column `text`."""

    @worker("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.replace_substring_regex(pc.utf8_lower(batch["text"]), _BETWEEN, " ")
            for at, end, data, offsets in chunks(texts, CHUNK):
                n = end - at
                best, score, sure, runs_of = ["und"] * n, np.zeros(n), np.zeros(n), [[] for _ in range(n)]
                words = words_of(data, offsets)
                if len(words) and model.labels:
                    distinct, example, which = np.unique(words.hashes(43), return_index=True, return_inverse=True)
                    bag, count = word_features(data, words.starts[example], words.ends[example], distinct)
                    log_scores = emissions(model.weights, bag, count)[which]
                    some = np.flatnonzero(np.diff(words.first))
                    first = np.append(words.first[some], len(words))
                    p = marginals(log_scores, first, model.transitions)
                    mean = np.add.reduceat(p, first[:-1], axis=0) / np.diff(first)[:, None]
                    certain = np.add.reduceat(p.max(axis=1), first[:-1]) / np.diff(first)
                    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
                    plain = letters[offsets[1:]] > letters[offsets[:-1]]
                    for row, i in enumerate(some):
                        if plain[i] or _has_letter(texts[at + i].as_py()):
                            top = int(mean[row].argmax())
                            best[i], score[i] = model.labels[top], min(1.0, float(mean[row, top]))
                            sure[i] = certain[row]
                            if spans:
                                own = p[first[row] : first[row + 1]].argmax(1)
                                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                                runs_of[i] = [{"first_word": a, "end_word": b, "lang": model.labels[own[a]]} for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(own)])]
                found = {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score), "sure": pa.array(sure)}
                columns = [*(batch[c].slice(at, n) for c in carried), *(found[c] for c in names)]
                out = [*carried, *names]
                if spans:
                    columns, out = [*columns, pa.array(runs_of, pa.list_(_SPAN))], [*out, "spans"]
                yield pa.RecordBatch.from_arrays(columns, out)

    return run


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 0 by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@worker("langid")
def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The field of a sample (lang, n, text), in one row."""
    sample = sorted(row for batch in batches for row in zip(*(batch[c].to_pylist() for c in ("lang", "n", "text"))))
    if not sample:
        return
    model = fit([t for *_, t in sample], [lang for lang, *_ in sample])
    weights, transitions = np.asarray(model.weights, np.float32), np.asarray(model.transitions, np.float64)
    columns = [pa.array([model.labels], pa.list_(pa.string())), pa.array([weights.tobytes()], pa.binary()), pa.array([transitions.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["labels", "weights", "transitions"])


def train(docs: DataFrame, per_language: int = 120, longest: int = 20_000, languages: int = 100) -> Model:
    """Fits to per_language texts of each of the `languages` langs that most rows have, those with the smallest hashes of their ids.

    Only rows with a text, a lang and an id that isn't held out count. Texts of over `longest` characters are
    taken only for a language that has too few others, and of them as many characters. So the sample, which one
    task holds and fits to, has per_language * languages * longest characters at most; the driver gets the model alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("doc_id is not null and text is not null and lang is not null").filter(~held_out())
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    rows = rows.join(F.broadcast(common.select("lang")), "lang").withColumn("text", F.substring("text", 1, longest + 1))
    order = Window.partitionBy("lang").orderBy(F.length("text") > longest, F.xxhash64("doc_id"), "doc_id", "text")
    rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    ship(docs.sparkSession)
    fitted = rows.select("lang", "n", "text").repartition(1).mapInArrow(_fitted, "labels array<string>, weights binary, transitions binary").collect()
    if not fitted:
        return fit([], [])
    names, weights, transitions = fitted[0]
    k = len(names)
    return Model(names, np.frombuffer(weights, np.float32).reshape(-1, k), np.frombuffer(transitions, np.float64).reshape(k, k))


def identify_languages(docs: DataFrame, model: Model | None = None, spans: bool = False) -> DataFrame:
    """Out, a row for each row of docs: doc_id, held_out, lang_pred, score, and with spans the runs of words by language.

    lang_pred is a lang value of the sample, or `und` with score 0 where the text is null or has no
    letter, or where no row could be learned from. Ties go to the alphabetically first. Rows may
    share a doc_id or have none (not held out, never learned from). Very long texts are read whole. An
    empty table gives no rows. Prediction reads the text alone, and no other columns matter.
    """
    ship(docs.sparkSession)
    model = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(_predict(model, spans), schema + ", spans array<struct<first_word:long,end_word:long,lang:string>>" * spans)


def accepted_documents(docs: DataFrame, least: float = 0.35, model: Model | None = None) -> DataFrame:
    """The rows of docs, with all their columns, whose words' languages are known: those not `und`, with a mean certainty
    of `least` or more over their words. So text that switches between languages stays. Rows may share a doc_id or have
    none; null and empty texts go; very long texts are read whole; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    model = model or train(docs)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.col("text").cast("string").alias("text"), row)
    schema = rows.select("row").schema.add("lang_pred", "string").add("sure", "double")
    judged = rows.mapInArrow(_predict(model, False, ("row",), ("lang_pred", "sure")), schema)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("sure") >= least)).select("row.*")
