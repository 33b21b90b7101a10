"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

The kernel of two words sums over all runs of three characters that both hold in order, with or
without other characters in between; every character spanned costs a factor, so an insult with
inserted or missing characters is still close to the plain one. Nyström landmarks are character
strings that set toxic texts apart, chosen greedily from the labelled ones. A text is described by
the largest kernel of its words with each landmark, mapped into the landmarks' feature space; a linear
machine separates the labelled texts, and its margins are turned into probabilities.

A bounded sample of labelled texts, as sets of words, is learned from in one task; the driver gets the
machine. Scoring uses whole
texts; a word met again is looked up.

Defined results: a null or empty text has no words and gets the score of those; labels that are
null or contradict each other are not learned from; without labels of both kinds the score is the share
of label 1 (one half without any); repeated rows are scored alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.llm.common import batch, fit_in_task, table, utf8
from trackmill.llm.quality import held_out, learnable
from trackmill.llm.shingles import lowered, span_hashes, word_spans

#: Bound on the labelled rows that one task fits on.
MOST_LABELLED = 4_000
THRESHOLD = 0.3
LANDMARKS = 32
SHORTEST, LONGEST = 4, 7
DECAY = 0.6
#: Landmarks that a toxic text should hold; texts with fewer call for more.
HELD = 5
#: Kernel values below this share of a landmark's own are taken as none.
FAINT = 0.1
#: Powers of the shares that describe a text, kernels as well: the first keeps what is left of a match
#: with gaps, the third tells whole matches from parts.
POWERS = (1, 3)
WINDOW = 24
KNOWN_WORDS = 2_000_000
WORDS_AT_ONCE = 20_000


def _codes(words: list[str], width: int, pad: int) -> np.ndarray:
    out = np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width)
    return np.where(out > 0, out, np.uint32(pad))


def kernel(words: list[str], landmarks: list[str], decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of order three of every word with every landmark."""
    if not words or not landmarks:
        return np.zeros((len(words), len(landmarks)), dtype=np.float32)
    width = max(1, max(map(len, words)))
    text = _codes(words, width, 0x110000)
    land = _codes(landmarks, max(map(len, landmarks)), 0x110001)
    total = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    # a word that holds the characters of fewer than three places of a landmark has kernel 0 with it
    letters = np.unique(land)
    holds = np.stack([(text == c).any(axis=1) for c in letters], axis=1).astype(np.float32)
    places = (land[:, :, None] == letters).sum(axis=1).astype(np.float32)
    which, mark = np.nonzero(holds @ places.T >= 3)
    text, land = np.ascontiguousarray(text[which].T), np.ascontiguousarray(land[mark].T)
    found = np.zeros(len(which), dtype=np.float32)
    one, two = (np.zeros(land.shape, dtype=np.float32) for _ in range(2))
    # sums up to each place of the landmark, of runs of one and two characters seen so far
    upto_one, upto_two = (np.zeros((len(land) + 1, len(which)), dtype=np.float32) for _ in range(2))
    decay = np.float32(decay)
    for now in text:
        match = (land == now) * decay**2
        found += (match * upto_two[:-1]).sum(axis=0)
        two *= decay
        two += match * upto_one[:-1]
        one *= decay
        one += match
        for sums, values in ((upto_one, one), (upto_two, two)):
            for place, value in enumerate(values):
                np.multiply(sums[place], decay, out=sums[place + 1])
                sums[place + 1] += value
    total[which, mark] = found
    return total


def similarities(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values as shares of each landmark's own; long words by windows, words that hold
    other characters than letters and digits also without these."""
    own = np.diag(kernel(landmarks, landmarks)) if landmarks else np.zeros(0)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    if not words or not landmarks:
        return out
    parts, first = [], []
    for word in words:
        first.append(len(parts))
        for form in (word,) if word.isalnum() else (word, "".join(filter(str.isalnum, word))):
            parts += [form[at : at + WINDOW] for at in range(0, max(1, len(form) - WINDOW // 2), WINDOW // 2)]
    order = sorted(range(len(parts)), key=list(map(len, parts)).__getitem__)
    found = np.zeros((len(parts), len(landmarks)), dtype=np.float32)
    for low in range(0, len(order), 2048):
        some = order[low : low + 2048]
        found[some] = kernel([parts[k] for k in some], landmarks) / own
    np.maximum.reduceat(found, first, out=out)
    out[out < FAINT] = 0
    return np.minimum(out, 1)


def _features(shares: np.ndarray) -> np.ndarray:
    return np.concatenate([shares**p for p in POWERS], axis=1)


def _grams(word: str) -> set[str]:
    return {word[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(word) - n + 1)}


def choose_landmarks(texts: list[set[str]], toxic: np.ndarray, most: int = LANDMARKS) -> list[str]:
    """Strings that toxic texts hold and others do not: greedily the one with most texts in need."""
    least = max(2, int(toxic.sum()) // 200)
    seen = Counter(g for words in (t for t, y in zip(texts, toxic) if y) for g in set().union(*map(_grams, words), ()))
    wanted = {g for g, n in seen.items() if n >= least}
    none: frozenset[str] = frozenset()
    of_word: dict[str, frozenset[str]] = {}
    where: dict[str, set[int]] = {g: set() for g in wanted}
    clean: Counter = Counter()
    for i, words in enumerate(texts):
        held: set[str] = set()
        for word in words:
            if word not in of_word:
                of_word[word] = frozenset(_grams(word) & wanted) or none
            held |= of_word[word]
        if toxic[i]:
            for g in held:
                where[g].add(i)
        else:
            clean.update(held)
    odds = max(1, len(toxic) - int(toxic.sum())) / max(1, int(toxic.sum()))
    precise = {g: len(w) / (len(w) + clean[g] / odds * 10) for g, w in where.items()}
    where = {g: w for g, w in where.items() if precise[g] >= 0.8}
    chosen: list[str] = []
    need = dict.fromkeys(set().union(*where.values()), HELD)
    while len(chosen) < most and where:
        best = max(where, key=lambda g: (len(where[g]) * precise[g], len(g), g))
        covered = where.pop(best)
        if len(covered) < least:
            break
        chosen.append(best)
        for i in covered:
            need[i] -= 1
        done = {i for i in covered if not need[i]}
        # another part of the same string adds nothing
        pieces = {best[i : i + SHORTEST] for i in range(len(best) - SHORTEST + 1)}
        where = {g: w - done for g, w in where.items() if not any(p in g for p in pieces)}
    return chosen


@dataclass
class Machine:
    landmarks: list[str]
    weights: np.ndarray
    bias: float

    def score(self, described: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(described @ self.weights + self.bias)))


def _separate(x: np.ndarray, y: np.ndarray, cost: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, both kinds weighing the same, by gradient steps."""
    sign = 2.0 * y - 1
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w, b = np.zeros(x.shape[1]), 0.0
    rate = len(y) / (len(y) + 2 * cost * float((share[:, None] * x**2).sum()) + 2 * cost * float(share.sum()))
    vw, vb = w, b
    for step in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ vw + vb)) * share * sign
        nw = vw - rate * (vw / len(y) - 2 * cost * (slack @ x) / len(y))
        nb = vb + rate * 2 * cost * slack.sum() / len(y)
        pull = step / (step + 3)
        vw, vb, w, b = nw + pull * (nw - w), nb + pull * (nb - b), nw, nb
    return w, b


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's logistic curve through the margins, by Newton steps."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        c = p * (1 - p)
        h = np.array([[(c * margin**2).sum() + 1e-3, (c * margin).sum()], [(c * margin).sum(), c.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a, b


def _with_spoiled(texts: list[set[str]], y: np.ndarray, landmarks: list[str]) -> tuple[list[set[str]], np.ndarray]:
    """Further toxic texts: those that hold landmarks, with a character of each missing, and with one
    more; so the machine learns how much of a match is left then."""
    out = []
    for words in (t for t, kind in zip(texts, y) if kind == 1):
        found = {w: m for w in words for m in landmarks if m in w}
        middle = {w: w.index(m) + len(m) // 2 for w, m in found.items()}
        for instead in ("", "0") if found else ():
            kept = set(words) - set(found)
            out.append(kept | {w[:i] + (w[i] + instead if instead else "") + w[i + 1 :] for w, i in middle.items()})
    return [*texts, *out], np.append(y, np.ones(len(out)))


def train(texts: list[set[str]], y: np.ndarray) -> Machine:
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    prior = Machine([], np.zeros(0), float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return prior
    landmarks = choose_landmarks(texts, y == 1)
    if not landmarks:
        return prior
    given, texts, y = len(texts), *_with_spoiled(texts, y, landmarks)
    vocabulary = sorted(set().union(*texts))
    place = {w: i for i, w in enumerate(vocabulary)}
    sizes = [len(t) for t in texts]
    of = np.fromiter((place[w] for t in texts for w in t), np.int32, sum(sizes))
    of = np.stack([of, np.repeat(np.arange(len(texts), dtype=np.int32), sizes)], axis=1)
    of = of[np.argsort(of[:, 0], kind="stable")]
    shares = np.zeros((len(texts), len(landmarks)), dtype=np.float32)
    for low in range(0, len(vocabulary), WORDS_AT_ONCE):
        values = similarities(vocabulary[low : low + WORDS_AT_ONCE], landmarks)
        word, text = of[slice(*np.searchsorted(of[:, 0], [low, low + WORDS_AT_ONCE]))].T
        near = values.any(axis=1)[word - low]
        np.maximum.at(shares, text[near], values[word[near] - low])
    x = _features(shares.astype(np.float64))
    # Nyström: the space in which the landmarks' kernel, of each power, is an inner product
    gram = kernel(landmarks, landmarks).astype(np.float64)
    scale = np.sqrt(np.diag(gram))
    into = np.zeros((x.shape[1], x.shape[1]))
    for i, power in enumerate(POWERS):
        size, turn = np.linalg.eigh((gram / scale[:, None] / scale) ** power + 0.05 * np.eye(len(landmarks)))
        own = slice(i * len(landmarks), (i + 1) * len(landmarks))
        into[own, own] = turn @ np.diag(size**-0.5) @ turn.T
    w, b = _separate(x @ into, y)
    a, c = _calibrate(((x @ into) @ w + b)[:given], y[:given])
    return Machine(landmarks, into @ w * a, b * a + c)


def _word_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        words = [" ".join(sorted({w.lower() for w in t.split()})) if t else "" for t in rows["text"]]
        yield pd.DataFrame({"label": rows["label"], "words": words})


def _learn(rows: pd.DataFrame) -> Machine:
    rows = rows.sort_values(["label", "words"])
    spelled: dict[str, str] = {}  # every word once in memory
    texts = [{spelled.setdefault(w, w) for w in words.split()} for words in rows["words"]]
    return train(texts, rows["label"].to_numpy(dtype=float))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Machine:
    """Learn ``toxic`` from the labelled rows that are not held out."""
    sample = learnable(labels, "toxic", held_out(4, 2), most)
    rows = (
        docs.select("doc_id", "text")
        .join(sample, "doc_id")
        .dropDuplicates(["doc_id"])
        .select("label", "text")
        .mapInPandas(_word_sets, "label int, words string")
    )
    return fit_in_task(rows, _learn)


class Describer:
    """Descriptions of texts; remembers by hash the words that are near a landmark, and the others."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.known = np.zeros(0, dtype=np.uint64)
        self.row = np.zeros(0, dtype=np.int64)
        self.values = np.zeros((1, len(landmarks)), dtype=np.float32)  # row 0: near no landmark

    def describe(self, texts: list[bytes]) -> np.ndarray:
        text = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        first = np.cumsum([1] + [len(t) + 1 for t in texts])
        out = np.zeros((len(texts), len(self.landmarks)), dtype=np.float32)
        self._pool(text, first, out)
        return _features(out)

    def _pool(self, text: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
        """Largest share of each text's words with each landmark, into ``out``."""
        low = lowered(text)
        start, end = word_spans(low)
        if not len(start) or not self.landmarks:
            return
        doc = np.searchsorted(first, start, "right") - 1
        distinct, where, which = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            if len(self.known) + new.sum() > KNOWN_WORDS:
                self.__init__(self.landmarks)
                new[:] = True
            spell = text.tobytes()
            words = [spell[start[i] : end[i]].decode("utf-8", "replace").lower() for i in where[new]]
            values = similarities(words, self.landmarks)
            near = values.any(axis=1)
            row = np.where(near, len(self.values) + np.cumsum(near) - 1, 0)
            self.values = np.concatenate([self.values, values[near]])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.row = known[order], np.concatenate([self.row, row])[order]
        row = self.row[np.searchsorted(self.known, distinct)][which]
        near = np.flatnonzero(row)
        np.maximum.at(out, doc[near], self.values[row[near]])


_DESCRIBERS: dict[tuple[str, ...], Describer] = {}


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(machine.landmarks)
        if key not in _DESCRIBERS:
            _DESCRIBERS.clear()  # one machine at a time
            _DESCRIBERS[key] = Describer(machine.landmarks)
        for rows in batches:
            texts = list(utf8(rows["text"]))
            found = [np.zeros(0)]
            for at in range(0, len(texts), 512):
                found.append(machine.score(_DESCRIBERS[key].describe(texts[at : at + 512])))
            yield batch(
                SCORED, doc_id=rows["doc_id"].cast(pa.int64()), held_out=rows["held_out"], score=np.concatenate(found)
            )

    return (
        docs.select("doc_id", "text", held_out(4, 2).alias("held_out"))
        .mapInArrow(scored, "doc_id long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
