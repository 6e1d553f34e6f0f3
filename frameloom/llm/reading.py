"""Reading level of each document (problem 9).

Prose is what is left of a text without code, links and markup. English prose is recognised paragraph by paragraph, whatever the
language column says, by the log-odds of its words, learnt from a sample of documents with their language columns: wrong entries
are put right by fitting again on what the first fit finds. Every sentence is classified: two regularised linear classifiers,
over words and over character n-grams, fitted on the sentences of the labelled documents, give it a distribution over the bands.
A document's sentence distributions and shapes go into a calibrated regression, whose value is cut into bands; it is fitted on
distributions that classifiers gave which had not seen the document (folds).

Both classifiers are additive over words, so a word's share of a sentence's scores is worked out once per distinct word.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANDS, WORDS, GRAMS, FOLDS = np.arange(1, 6), 2048, 1024, 5
FENCE = re.compile(r"(?:```|~~~).*?(?:```|~~~|\Z)", re.S)
BLOCK = re.compile(r"<(pre|code|script|style)\b.*?</\1\s*>", re.S | re.I)
INDENTED = re.compile(r"^(?: {4,}|\t).*$", re.M)
INLINE = re.compile(r"`[^`\n]*`")
LINK = re.compile(r"\[([^\]\n]*)\]\([^)\s]*\)")
URL = re.compile(r"<?(?:https?|ftp)://[^\s>]+>?|www\.\S+", re.I)
TAG = re.compile(r"</?[a-z][^<>]*>", re.I)
BREAK = re.compile(r"</?(?:p|br|div|li|ul|ol|h\d|blockquote)\b[^<>]*>", re.I)
MARK = re.compile(r"^[ \t]*(?:>[ \t]?|[-*+] |#+ |\d+\. )+", re.M)
SENTENCE = re.compile(r"[.!?…]+(?=\s|$)")
TOKEN = re.compile(r"[^\W\d_]+(?:['’‑-][^\W\d_]+)*")


class English:
    """Log-odds of words for English against other languages."""

    RATE = 1e-5  # added to a word's share in either class, so a rare word says little

    def __init__(self, docs: list[dict[str, int]], english: list[bool], rounds: int = 4):
        """Fitted on word counts of documents and whether each is said to be English. Without both kinds any word seen is English."""
        own = np.array(english, bool)
        for _ in range(rounds):
            self.odds = self._odds(docs, own)
            scores = np.array([self.score(Counter(d)) if d else 0.0 for d in docs])
            typical = float(np.median(scores[own])) if own.any() else 1.0
            self.least = 0.4 * typical
            again = scores >= self.least
            if not again.any() or again.all() or np.array_equal(again, own):
                break
            own = again

    def _odds(self, docs: list[dict[str, int]], own: np.ndarray) -> dict[str, float]:
        sides = [Counter(), Counter()]
        for d, e in zip(docs, own.tolist()):
            sides[e].update(d)
        whole = [max(1, sum(c.values())) for c in sides]
        other, en = sides
        return {w: float(np.log((en[w] / whole[1] + self.RATE) / (other[w] / whole[0] + self.RATE))) for w in {*other, *en} if en[w] + other[w] > 1}

    def score(self, words: Counter) -> float:
        """The mean log-odds of words; unknown ones count as nought."""
        return sum(n * self.odds.get(w, 0.0) for w, n in words.items()) / max(1, sum(words.values()))

    def __call__(self, words: list[str]) -> bool:
        return sum(self.odds.get(w, 0.0) for w in words) >= self.least * len(words)


def paragraphs(text: str) -> list[str]:
    """The paragraphs of a text without code, links and markup, in lower case."""
    text = FENCE.sub("\n\n", text)
    if "<" in text or "&" in text:
        text = BLOCK.sub("\n\n", text)
        text = html.unescape(TAG.sub(" ", BREAK.sub("\n\n", URL.sub(" ", text)))).replace("\xa0", " ")
    text = MARK.sub("", INDENTED.sub("", text))
    if "`" in text:
        text = INLINE.sub(" ", text)
    if "](" in text:
        text = LINK.sub(r"\1", text)
    if "://" in text or "www." in text:
        text = URL.sub(" ", text)
    return [p.lower() for p in re.split(r"\n\s*\n", text)]


def prose(text: str, english: English) -> list[list[str]]:
    """The sentences of a text's English prose, as lower-case words; commas and semicolons stay as words of their own."""
    out = []
    for paragraph in paragraphs(text):
        words = TOKEN.findall(paragraph)
        if words and english(words):
            for part in SENTENCE.split(paragraph):
                if found := TOKEN.findall(part):
                    out.append(found + [","] * (part.count(",") + part.count(";")))
    return out


def n_words(sentences: list[list[str]]) -> int:
    return sum(len(s) - s.count(",") for s in sentences)


def _pieces(word: str, chars: bool) -> list[int]:
    if not chars:
        return [zlib.crc32(word.encode()) % WORDS]
    w = f"^{word}$"
    grams = [w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)] or [w]
    return [zlib.crc32(g.encode()) % GRAMS for g in grams]


def _bags(sentences: list[list[str]], chars: bool) -> np.ndarray:
    """A row a sentence: the shares of its words' pieces, longer sentences counting more."""
    x, known = np.zeros((len(sentences), GRAMS if chars else WORDS), np.float32), {}
    for row, s in zip(x, sentences):
        for w in s:
            if w not in known:
                known[w] = _pieces(w, chars)
            np.add.at(row, known[w], 1 / (len(known[w]) * len(s) ** 0.5)) if len(known[w]) > 1 else row.__setitem__(known[w][0], row[known[w][0]] + 1 / len(s) ** 0.5)
    return x


def _targets(levels: np.ndarray) -> np.ndarray:
    """A row a level: its weight in each band; one between two bands has parts of both."""
    return np.maximum(0, 1 - np.abs(levels[:, None] - BANDS))


class SentenceClassifier:
    """Regularised least-squares classification of sentences, by words or by character n-grams: a score a band for each word."""

    STRENGTHS = (3.0, 10.0, 30.0)

    def __init__(self, docs: list[list[list[str]]], levels: np.ndarray, chars: bool, fold: np.ndarray):
        """``out`` has the weights that each fold's documents are classified with: those of the other folds."""
        self.chars, width = chars, GRAMS if chars else WORDS
        gram, cross, count = np.zeros((FOLDS, width, width)), np.zeros((FOLDS, width, 5)), np.zeros(5)
        y = _targets(levels)
        for f in range(FOLDS):
            own = np.flatnonzero(fold == f)
            sentences, of = [s for d in own for s in docs[d]], np.repeat(own, [len(docs[d]) for d in own])
            for lo in range(0, len(sentences), 4096):
                x = _bags(sentences[lo : lo + 4096], chars)
                gram[f] += x.T @ x
                size = np.array([len(s) for s in sentences[lo : lo + 4096]], np.float32) ** 0.5
                cross[f] += x.T @ ((y[of[lo : lo + 4096]] - y.mean(0)) * size[:, None])
        self.start = y.mean(0)
        whole, total = gram.sum(0), cross.sum(0)
        best = None
        for strength in self.STRENGTHS:
            w = self._solve(whole - gram[0], total - cross[0], strength)
            loss = float(np.sum(w * (gram[0] @ w)) - 2 * np.sum(w * cross[0]))  # squared error on the fold, but for a constant
            if best is None or loss < best[0]:
                best = (loss, strength, w)
        self.out = [best[2] if f == 0 else self._solve(whole - gram[f], total - cross[f], best[1]) for f in range(FOLDS)]
        self.weights = self._solve(whole, total, best[1])

    @staticmethod
    def _solve(gram: np.ndarray, cross: np.ndarray, strength: float) -> np.ndarray:
        return np.linalg.solve(gram + strength * np.eye(len(gram)), cross)


class _Scores:
    """Words' scores by the word and by the character classifier, worked out when first met; bounded by starting anew."""

    MOST = 300_000

    def __init__(self, weights: tuple[np.ndarray, np.ndarray]):
        self.weights, self.at, self.rows = weights, {}, np.zeros((1024, 10), np.float32)

    def _add(self, word: str) -> int:
        n = len(self.at)
        if n == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        for i, (w, chars) in enumerate(zip(self.weights, (False, True))):
            self.rows[n, 5 * i : 5 * i + 5] = w[_pieces(word, chars)].mean(0)
        self.at[word] = n
        return n

    def sums(self, doc: list[list[str]]) -> np.ndarray:
        """A row a sentence: the sum of its words' scores."""
        if len(self.at) > self.MOST:
            self.at = {}
        known = self.at
        where = [known[w] if w in known else self._add(w) for s in doc for w in s]
        return np.add.reduceat(self.rows[where], np.cumsum([0, *(len(s) for s in doc[:-1])]), axis=0).astype(np.float64)


def _ridge(x: np.ndarray, y: np.ndarray, strengths: tuple[float, ...]) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, intercept and leave-one-out predictions of ridge regression over few columns; the strength by those."""
    mean, level = x.mean(0), y.mean()
    u, s, v = np.linalg.svd(x - mean, full_matrices=False)
    best, inside = None, u.T @ (y - level)
    for strength in strengths:
        shrink = s**2 / (s**2 + strength * len(y))
        hat = (u**2 * shrink).sum(1) + 1 / len(y)
        out = y - (y - level - u @ (shrink * inside)) / np.maximum(1 - hat, 1e-3)
        loss = ((out - y) ** 2).mean()
        if best is None or loss < best[0]:
            best = (loss, strength, out)
    w = v.T @ (s * inside / (s**2 + best[1] * len(y)))
    return w, float(level - mean @ w), best[2]


class ReadingModel:
    """Fitted on documents' sentences and their levels (1 to 5, fractions allowed)."""

    def __init__(self, docs: list[list[list[str]]], levels: np.ndarray):
        y = np.asarray(levels, np.float64)
        fold = np.arange(len(docs)) * FOLDS // len(docs)
        fold = fold[np.random.default_rng(3).permutation(len(docs))]
        parts = [SentenceClassifier(docs, y, chars, fold) for chars in (False, True)]
        self.starts = np.concatenate([p.start for p in parts])
        self.weights = tuple(p.weights for p in parts)
        # the calibration sees each document as classifiers saw it that were fitted without it
        rows = np.zeros((len(docs), self.width()))
        for f in range(FOLDS):
            scores = _Scores(tuple(p.out[f] for p in parts))
            for i in np.flatnonzero(fold == f):
                rows[i] = self.features(docs[i], scores)
        self.mean, self.scale = rows.mean(0), rows.std(0) + 1e-9
        w, b, out = _ridge((rows - self.mean) / self.scale, y, (0.0003, 0.001, 0.003, 0.01, 0.03, 0.1))
        self.final = (w, b)
        self.cuts = self._cuts(out, y)

    @staticmethod
    def width() -> int:
        return 2 * 5 + 2 + 5 + 5

    @staticmethod
    def _cuts(out: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Where values are cut into bands: with few labels half way, else where the fewest labelled documents fall wrong."""
        cuts = np.arange(1.5, 5)
        if len(y) < 150:
            return cuts
        for i, c in enumerate(cuts):
            near = np.linspace(c - 0.3, c + 0.3, 61)
            wrong = np.array([((out >= t) != (y > c)).mean() for t in near])
            cuts[i] = near[np.flatnonzero(wrong <= wrong.min() + 1e-12)].mean()
        return np.maximum.accumulate(cuts)

    def features(self, doc: list[list[str]], scores: _Scores) -> list[float]:
        """Mean scores by both classifiers and their levels, the mean distribution of the sentences over the bands, and how long
        sentences and words are."""
        size = np.array([len(s) for s in doc], float)
        each = scores.sums(doc) / size[:, None] + self.starts
        mean = (each * size[:, None]).sum(0) / size.sum()
        commas, letters = sum(s.count(",") for s in doc), sum(len(w) for s in doc for w in s)
        words = size.sum() - commas
        # a sentence's distribution over the bands: scores as log-odds, sharper the longer it is
        z = (each[:, :5] + each[:, 5:]) * (2 * np.sqrt(np.minimum(size, 40)))[:, None]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        share = (p * size[:, None]).sum(0) / size.sum()
        levels = p @ BANDS
        return [*mean, mean[:5] @ BANDS, mean[5:] @ BANDS, *share, np.log(words / len(doc)), words / len(doc), letters / words, commas / len(doc), float(levels.std())]

    def bands(self, docs: list[list[list[str]]], scores: _Scores | None = None) -> np.ndarray:
        if not docs:
            return np.zeros(0, np.int32)
        scores = scores if scores is not None else _Scores(self.weights)
        rows = np.array([self.features(d, scores) for d in docs])
        value = ((rows - self.mean) / self.scale) @ self.final[0] + self.final[1]
        return (1 + (value[:, None] >= self.cuts).sum(1)).astype(np.int32)


def learn_english(documents: DataFrame, most: int = 4000) -> English:
    """Fitted on about ``most`` documents that have a text and a language (all, if there are no more), chosen by a hash of doc_id; where
    none has a language, on texts that all count as English."""
    lang = F.lower(F.trim(F.regexp_extract(F.col("lang").cast("string"), "^[^-_]*", 0))) if "lang" in documents.columns else F.lit("").cast("string")
    rows = documents.where("text is not null and doc_id is not null").select(F.col("text").cast("string").alias("text"), lang.alias("lang"), (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)).alias("at"))
    known = F.col("lang").isNotNull() & ~F.col("lang").isin("", "und")
    n = rows.agg(F.count(F.when(known, 1)).alias("known"), F.count("*").alias("all")).first()
    some, whole = (rows.where(known), n.known) if n.known else (rows, n["all"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [Counter(w for p in paragraphs(t) for w in TOKEN.findall(p)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32())), b.column(1)], ["words", "n", "lang"])

    # the share that is taken bounds what comes to the driver; the limit only matters where one doc_id has very many rows
    got = some.where(F.col("at") < most / max(1, whole)).select("text", "lang").mapInArrow(count, "words array<string>, n array<int>, lang string").limit(2 * most + 100).collect()
    return English([dict(zip(r.words, r.n)) for r in got], [r.lang == "en" or not n.known for r in got])


def labelled_prose(documents: DataFrame, labels: DataFrame, english: English, most: int = 1500, least_words: int = 20) -> tuple[list, np.ndarray]:
    """Sentences and mean label of at most ``most`` labelled documents, chosen by a hash of doc_id."""
    mean = labels.where("band between 1 and 5 and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("band").alias("level"))
    chosen = F.broadcast(mean.orderBy(F.xxhash64("doc_id")).limit(most))  # the limit bounds what is sent

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [prose(t or "", english) for t in b.column(1).to_pylist()]
            ok = [n_words(x) >= least_words for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_())), b.column(2).filter(pa.array(ok, pa.bool_())), pa.array([x for x, y in zip(found, ok) if y], pa.list_(pa.list_(pa.string())))], ["doc_id", "level", "prose"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("level").alias("level"))  # of a repeated doc_id one text
    got = sorted(rows.mapInArrow(read, "doc_id long, level double, prose array<array<string>>").toLocalIterator(), key=lambda r: (r.doc_id, r.level))
    return [r.prose for r in got], np.array([r.level for r in got])


def reading_bands(documents: DataFrame, labels: DataFrame, least_words: int = 40, most_labels: int = 1500, most_languages: int = 4000) -> DataFrame:
    """doc_id, band (1 to 5) of each document with at least ``least_words`` words of English prose outside code and links.

    Null, blank and other texts have no row. Several labels of a document count as their mean; null or other bands are left
    out. With fewer than 10 labelled documents that have prose, no model can be fitted, and a ValueError says so. ``most_labels``
    bounds the labelled documents that are used, ``most_languages`` those that English is learnt from. A repeated doc_id comes out
    as often.
    """
    english = learn_english(documents, most_languages)
    docs, levels = labelled_prose(documents, labels, english, most_labels)
    if len(docs) < 10:
        if documents.isEmpty():
            return documents.sparkSession.createDataFrame([], "doc_id long, band int")
        raise ValueError(f"{len(docs)} labelled documents with prose; 10 are needed")
    model = ReadingModel(docs, levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model.weights)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                found = [prose(t, english) if t else [] for t in part.column(1).to_pylist()]
                ok = [n_words(x) >= least_words for x in found]
                bands = model.bands([x for x, y in zip(found, ok) if y], scores)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok, pa.bool_())), pa.array(bands, pa.int32())], ["doc_id", "band"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, band int")
