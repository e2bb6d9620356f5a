"""Language identification by unigrams over subword pieces, with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability in a language
is the sum over all its segmentations into pieces of the product of their probabilities, by the forward
algorithm; a text's is the product over its words. Learning runs expectation-maximisation over the word counts
of each language: the expected uses of each piece, over all segmentations, become its new probability.

A word is a run of letters, lower-cased; one of over `WORD` letters is scored in parts of that length.

Cases: a null text or one without a letter is `und` with score 0, and so is every text if nothing was learned;
ties go to the language that sorts first; null ids and repeated rows are answered like any other; documents
without text or language are not learned from, and a repeated text of a language counts once; columns other than
those named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from clientlens.llm.common import drawn, kept, slices, staged

WORD = 40
# Marks the beginning of a word in the vocabulary (fixed value).
BEGIN = "▁"
# Probabilities of segmentations are held times this for each letter: 40 letters of the rarest pieces stay
# above the smallest number, and 40 of the most frequent ones below the largest.
SCALE = 1e4


class Pieces:
    """The pieces that are words or parts of words, as a trie in arrays; number 0 is any letter that is none.

    An edge's key is its upper node and its letter, so many words are looked up letter by letter at a time.
    """

    def __init__(self, pieces: list[str]) -> None:
        edges: dict[int, int] = {}
        number = [0]
        for n, piece in enumerate(pieces, start=1):
            node = 0
            for letter in piece:
                node = edges.setdefault((node << 21) | ord(letter), len(edges) + 1)
                if node == len(number):
                    number.append(0)
            number[node] = n
        self.count = len(pieces) + 1
        self.longest = max(map(len, pieces), default=0)
        self.keys = np.array(sorted(edges), dtype=np.int64)
        self.below = np.array([edges[k] for k in self.keys.tolist()], dtype=np.int64)
        self.number = np.array(number, dtype=np.int64)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether there is such an edge, the node below it)."""
        keys = (nodes << 21) | letters
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return (self.keys[at] == keys, self.below[at]) if len(self.keys) else (np.zeros(len(keys), bool), nodes)


def load_pieces(path: str) -> Pieces:
    model = SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    word = [p for p in found if p.removeprefix(BEGIN).isalpha() and p == p.lower()]
    return Pieces([*dict.fromkeys(word), BEGIN])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and the text that each stands in."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\PL+")
    flat, owner = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), owner.filter(full).to_numpy()


def parts_of(word: str) -> list[str]:
    """A word with its mark, in parts if it is long."""
    return [BEGIN + word[i : i + WORD] for i in range(0, len(word), WORD)]


@dataclass
class Lattice:
    """Every piece at every place of some words: arrays over the edges, sorted by end, then word."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, words: list[str], pieces: Pieces) -> Lattice:
        length = np.array([len(w) for w in words], dtype=np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
        at, node = np.arange(len(letters)), np.zeros(len(letters), dtype=np.int64)
        found = []
        for size in range(1, max(pieces.longest, 1) + 1):
            inside = place[at] + size <= length[word[at]]
            at, node = at[inside], node[inside]
            known, below = pieces.step(node, letters[at + size - 1])
            number = np.where(known, pieces.number[below], 0)
            # A single letter is an edge in any case.
            edge = (number > 0) | (size == 1)
            found.append(np.stack([at[edge], np.full(edge.sum(), size), number[edge]]))
            at, node = at[known], below[known]
        at, size, piece = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
        end = place[at] + size
        order = np.lexsort((at, word[at], end))
        at = at[order]
        return cls(word[at], place[at], end[order], piece[order], length)

    def scaled(self, weights: np.ndarray) -> np.ndarray:
        """Weights of the edges, times SCALE for each letter."""
        factor = SCALE ** (self.end - self.start)
        return weights * factor.reshape(-1, *[1] * (weights.ndim - 1))

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """alpha[word, place, ...]: summed probability of the first `place` letters; weight: by edge."""
        alpha = np.zeros((len(self.length), self.length.max(initial=0) + 1, *weight.shape[1:]))
        alpha[:, 0] = 1
        for j, edges in self._levels(self.end):
            word = self.word[edges]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            alpha[word[first], j] = np.add.reduceat(alpha[word, self.start[edges]] * weight[edges], first)
        return alpha

    def backward(self, weight: np.ndarray) -> np.ndarray:
        beta = np.zeros((len(self.length), self.length.max(initial=0) + 1))
        beta[np.arange(len(self.length)), self.length] = 1
        order = np.lexsort((self.word, self.start))
        for i, at in reversed(list(self._levels(self.start[order]))):
            edges = order[at]
            np.add.at(beta, (self.word[edges], i), beta[self.word[edges], self.end[edges]] * weight[edges])
        return beta

    @staticmethod
    def _levels(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        for a, b in zip(cuts, [*cuts[1:], len(keys)]):
            yield int(keys[a]), slice(a, b)


@dataclass
class Model:
    """Probability of each piece in each language."""

    languages: list[str]
    pieces: Pieces
    weights: np.ndarray  # [piece, language]


def _probabilities(counts: np.ndarray, smoothing: float) -> np.ndarray:
    counts = counts + smoothing
    return counts / counts.sum(axis=0)


def fit(
    labelled: DataFrame,
    *,
    vocabulary_path: str,
    text_col: str = "text",
    lang_col: str = "lang",
    fit_rows: int = 3000,
    rounds: int = 3,
    smoothing: float = 0.02,
) -> Model:
    """Learn from about `fit_rows` different texts at most, chosen by their hash (the bound of the sample).

    Word counts by language stay in Spark; the driver gets one number for each piece and language.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    rows = drawn(rows, "text", fit_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, owner = words_of(batch.column("text"))
            lang = batch.column("lang").take(pa.array(owner))
            counts = pa.table([lang, words], ["lang", "word"]).group_by(["lang", "word"]).aggregate([([], "count_all")])
            yield from counts.rename_columns(["lang", "word", "n"]).combine_chunks().to_batches()

    counts = rows.mapInArrow(count, "lang string, word string, n long")
    counts = staged(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    pieces = load_pieces(vocabulary_path)
    model = Model(languages, pieces, np.full((pieces.count, len(languages)), 1.0 / pieces.count))
    for _ in range(rounds if languages else 0):
        weights, column = model.weights, {lang: k for k, lang in enumerate(languages)}

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = np.zeros_like(weights)
            for batch in batches:
                for rows in (batch.slice(i, 5000) for i in range(0, batch.num_rows, 5000)):
                    parts = [parts_of(w) for w in rows.column("word").to_pylist()]
                    times = [len(p) for p in parts]
                    lattice = Lattice.of([p for ps in parts for p in ps], pieces)
                    k = np.repeat([column[lang] for lang in rows.column("lang").to_pylist()], times)
                    n = np.repeat(rows.column("n").to_numpy(zero_copy_only=False), times)
                    p = lattice.scaled(weights[lattice.piece, k[lattice.word]])
                    alpha, beta = lattice.forward(p), lattice.backward(p)
                    whole = alpha[np.arange(len(k)), lattice.length]
                    used = alpha[lattice.word, lattice.start] * p * beta[lattice.word, lattice.end]
                    used *= (n / whole)[lattice.word]
                    np.add.at(totals, (lattice.piece, k[lattice.word]), used)
            at, k = np.nonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(k), pa.array(totals[at, k])], ["piece", "lang", "used"]
            )

        expected = counts.mapInArrow(expect, "piece long, lang long, used double").groupBy("piece", "lang")
        new = np.zeros_like(weights)
        for piece, k, used in expected.agg(F.sum("used")).collect():
            new[piece, k] = used
        model = Model(languages, pieces, _probabilities(new, smoothing))
    return model


class Scorer:
    """Log-probabilities of texts in every language.

    Scores of words are remembered in two generations of at most `most` words and `letters` letters each: when
    the younger is full it becomes the older one, and words that are met again move to the younger. Words of
    over `long` letters are not remembered.
    """

    def __init__(self, model: Model, most: int = 200_000, letters: int = 4_000_000, long: int = 200) -> None:
        self.model, self.most, self.letters, self.long = model, most, letters, long
        self.older: dict[str, bytes] = {}
        self.younger: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, words: list[str]) -> np.ndarray:
        """By word: log-probability in each language, then the number of its parts."""
        out = np.zeros((len(words), len(self.model.languages) + 1), dtype=np.float32)
        for i in range(0, len(words), 4000):
            parts = [parts_of(w) for w in words[i : i + 4000]]
            owner = np.repeat(np.arange(i, i + len(parts)), [len(p) for p in parts])
            lattice = Lattice.of([p for ps in parts for p in ps], self.model.pieces)
            alpha = lattice.forward(lattice.scaled(self.model.weights[lattice.piece]))
            whole = np.log(alpha[np.arange(len(owner)), lattice.length]) - lattice.length[:, None] * np.log(SCALE)
            np.add.at(out, owner, np.concatenate([whole, np.ones((len(owner), 1))], axis=1))
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """The scores of different words."""
        found = [self.younger.get(w) for w in words]
        fresh = [n for n, s in enumerate(found) if s is None]
        for n in fresh:
            found[n] = self.older.get(words[n])
        new = [n for n in fresh if found[n] is None]
        for n, scores in zip(new, self._learn([words[n] for n in new])):
            found[n] = scores.tobytes()
        for n in fresh:
            if len(words[n]) <= self.long:
                if len(self.younger) >= self.most or self.held >= self.letters:
                    self.older, self.younger, self.held = self.younger, {}, 0
                self.younger[words[n]] = found[n]
                self.held += len(words[n])
        return np.frombuffer(b"".join(found), dtype=np.float32).reshape(len(words), -1)

    def sums(self, texts: pa.Array) -> np.ndarray:
        """By text: log-probability in each language, then the number of words."""
        words, owner = words_of(texts)
        out = np.zeros((len(texts), len(self.model.languages) + 1))
        if len(words):
            coded = words.dictionary_encode()
            scores, at = self.words(coded.dictionary.to_pylist()), coded.indices.to_numpy()
            for k in range(out.shape[1]):
                out[:, k] = np.bincount(owner, weights=scores[at, k], minlength=len(texts))
        return out


def _scorer(model: Model) -> Scorer:
    """The scorer of a model in this Python worker: its memory lasts from task to task."""
    mark = repr(model.languages).encode() + hashlib.sha256(model.weights.tobytes()).digest()
    return kept(("language", mark), lambda: Scorer(model))


def identify(
    docs: DataFrame,
    model: Model,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    evidence_words: int = 20,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, lang_pred, score, *keep) of every document.

    score is the posterior of the predicted language from the mean evidence of a word, counted for at most
    `evidence_words` words, so that long texts in two languages do not look certain.
    """
    clashing = {c: f"kept{i}" for i, c in enumerate(keep)}
    languages = np.array([*model.languages, "und"], dtype=object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches, "text", 6_000_000):
            sums = scorer.sums(batch.column("text"))
            words, logs = sums[:, -1], sums[:, :-1]
            known = (words > 0) & bool(model.languages)
            best = np.full(len(sums), len(model.languages))
            certain = np.zeros(len(sums))
            if known.any():
                mean = logs[known] / words[known, None] * np.minimum(words[known, None], evidence_words)
                share = np.exp(mean - mean.max(axis=1, keepdims=True))
                best[known] = mean.argmax(axis=1)
                certain[known] = share.max(axis=1) / share.sum(axis=1)
            columns = [batch.column("id"), pa.array(languages[best], pa.string()), pa.array(certain)]
            columns += [batch.column(c) for c in clashing.values()]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(k) for c, k in clashing.items())
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    names = ["id", "lang_pred", "score", *clashing.values()]
    schema = f"id {kinds['id']}, lang_pred string, score double"
    schema += "".join(f", {k} {kinds[k]}" for k in clashing.values())
    found = source.mapInArrow(score, schema)
    return found.select(F.col("id").alias(id_col), "lang_pred", "score", *(F.col(k).alias(c) for c, k in clashing.items()))
