"""Scoring documents for abusive, hateful or sexual content with a small convolutional classifier.

Text is normalised against disguise (letters spread by blanks or dots, symbols within words, digits
for letters, stretched letters), split into sentences, and each sentence is scored by a network
trained here in numpy: words and their letter pieces are hashed into one embedding table, filters
of one, two and three words slide over the sentence, each filter keeps its maximum, and a logistic
unit weighs them. A document's score is that of its worst sentence.

Labels are given for documents, by annotators who err and disagree. Training is by multiple
instances: sentences of documents labelled clean are clean; of a document labelled abusive, only
sentences whose words other abusive documents share and clean ones lack stand for it, and a
document without such a sentence is taken for a slip and left out. Thresholds are calibrated by
language on scores of documents that the scoring model has not seen.

The fit uses a bounded sample: at most max_labelled documents, in the order of a hash of their id.
Scoring covers every document and every sentence; repeated sentences are scored once a worker.

Defined results: null, empty and blank texts score 0; a repeated document row gives a repeated
score; documents without language count as Korean or English by their letters; without usable
labels of both kinds every score is 0 and nothing is found; very long texts are scored whole; other
columns are not read.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.plans.runtime import materialize

MAX_LABELLED = 6000
#: letters of a word that is taken whole: Latin, and of other scripts
WHOLE_LATIN, WHOLE = 16, 8
#: a whole word between marks, its pairs and its triples of letters
PIECES = 1 + (WHOLE_LATIN + 1) + WHOLE_LATIN
BUCKETS, DIM, FILTERS, WIDTHS, WORDS = 1 << 15, 24, 32, (1, 2, 3), 28

#: fixed values: names of markup elements
ELEMENTS = "a abbr article b big blockquote body br center code dd del div dl dt em font footer h1 h2 h3 h4 h5 h6 head header hr html i img ins label li link main mark meta nav ol option p pre q s script section select small span strike strong style sub sup table tbody td tfoot th thead title tr u ul".split(" ")
INVISIBLE = re.compile("[­​-‏⁠﻿]")
MARKUP = re.compile(rf"""</?(?:{"|".join(ELEMENTS)})(?:\s+[a-z-]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s<>"']+))?)*\s*/?>""", re.I)
SPREAD = re.compile(r"(?<![가-힣a-z])(?:[가-힣a-z](?:[ .\-_*·~]{1,3}|$)){2,}[가-힣a-z](?![가-힣a-z])")
INSIDE = re.compile(r"(?<=[가-힣a-z])[.*_\-~^·'`|+#/\\!?]+(?=[가-힣a-z])")
STRETCHED = re.compile(r"(.)\1{2,}")
LEET = re.compile(r"(?<![a-z0-9@$])(?=[013457@$!]*[a-z])[a-z013457@$!]*[a-z013457@$](?![a-z0-9@$])")
MARKED = re.compile(r"[a-z][013457]*[@$]|[@$][013457]*[a-z]|[a-z][013457!@$]+[a-z]")
LEET_LETTERS = str.maketrans("013457@$!", "oieastasi")
NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
SENTENCE = re.compile(r"(?<=[.!?。…])\s+|[\r\n]+|(?<=[.!?])(?=[\"'」』)\]])")
WORD = re.compile(r"[가-힣]+|[a-z]+|0")


def split_sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.split(MARKUP.sub(" ", text)) if s and not s.isspace()]


def _letters_for_signs(s: str) -> str:
    """A sentence with a sign beside letters or a digit between letters has all such words in letters; else room101 and 3rd stay.

    Words longer than any that is taken whole are writing without blanks: their digits are numbers.
    """
    if any(len(m[0]) <= WHOLE_LATIN and MARKED.search(m[0]) for m in LEET.finditer(s)):
        return LEET.sub(lambda m: m[0].translate(LEET_LETTERS) if len(m[0]) <= WHOLE_LATIN else m[0], s)
    return s


def normalize(sentence: str) -> list[str]:
    """Words of a sentence with disguise undone."""
    s = INVISIBLE.sub("", unicodedata.normalize("NFKC", sentence)).lower()
    s = _letters_for_signs(s)
    s = NUMBER.sub("0", s)
    s = STRETCHED.sub(r"\1", s)
    s = INSIDE.sub("", s)
    s = SPREAD.sub(lambda m: re.sub(r"[^가-힣a-z]", "", m[0]) + " ", s)
    return [p for w in WORD.findall(s) for p in _chunks(w)]


def _chunks(word: str) -> list[str]:
    """Writing without blanks is cut into overlapping stretches of letters, so that all of it is seen."""
    whole = WHOLE if word > "z" else WHOLE_LATIN
    if len(word) <= whole:
        return [word]
    return [word[i : i + whole // 2] for i in range(0, len(word) - whole // 4, whole // 4)]


def _bucket(piece: str) -> int:
    return zlib.crc32(piece.encode()) % (BUCKETS - 1) + 1


def word_buckets(word: str) -> list[int]:
    """The word and all its letter pieces."""
    w = f"<{word}>"
    grams = [w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1)]
    return [_bucket(w), *map(_bucket, grams)]


class Encoder:
    """Sentences to arrays of word numbers, and the buckets of each word; number 0 is no word."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.rows = np.zeros((1024, PIECES), np.int32)

    def word(self, w: str) -> int:
        k = self.numbers.get(w)
        if k is None:
            k = self.numbers[w] = len(self.numbers) + 1
            if k >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            b = word_buckets(w)
            self.rows[k, : len(b)] = b
        return k

    @property
    def table(self) -> np.ndarray:
        return self.rows[: len(self.numbers) + 1]

    def windows(self, words: list[str]) -> list[list[str]]:
        """A long sentence is cut into overlapping windows, so that none of it is dropped."""
        if len(words) <= WORDS:
            return [words] if words else []
        return [words[i : i + WORDS] for i in range(0, len(words) - 3, WORDS - 4)]

    def __call__(self, windows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(windows), WORDS), dtype=np.int32)
        for i, ws in enumerate(windows):
            out[i, : len(ws)] = [self.word(w) for w in ws]
        return out


class Net:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.e = (r.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.e[0] = 0
        self.w = [(r.standard_normal((n * DIM, FILTERS)) * np.sqrt(2 / (n * DIM))).astype(np.float32) for n in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.o = (r.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
        self.c = np.float32(-2.0)

    def word_vectors(self, table: np.ndarray, batch: int = 4096) -> np.ndarray:
        """A row a word: the sum of its buckets' vectors over the root of their number."""
        parts = [self.e[t].sum(1) / np.sqrt(np.maximum((t > 0).sum(1, keepdims=True), 1)) for t in (table[i : i + batch] for i in range(0, len(table), batch))]
        return np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, DIM), np.float32)

    def forward(self, h: np.ndarray, real: np.ndarray):
        pooled, where, wins = [], [], []
        for k, width in enumerate(WIDTHS):
            win = np.concatenate([h[:, i : WORDS - width + 1 + i] for i in range(width)], axis=2)
            z = win @ self.w[k] + self.b[k]
            z = np.where(real[:, : WORDS - width + 1, None], z, -1e9)
            at = z.argmax(1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            where.append(at)
            wins.append(win)
        return np.concatenate(pooled, 1), where, wins

    def scores(self, x: np.ndarray, vectors: np.ndarray, batch: int = 512) -> np.ndarray:
        """x: word numbers; vectors: word_vectors of all of them."""
        out = [self.forward(vectors[b], b > 0)[0] @ self.o + self.c for b in (x[i : i + batch] for i in range(0, len(x), batch))]
        z = np.concatenate(out) if out else np.zeros(0, np.float32)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, x: np.ndarray, table: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int, seed: int = 3, rate: float = 0.004, keep: float = 0.7, batch: int = 128) -> None:
        """Adam on weighted log-loss with dropout on the pooled filters; embeddings get sparse updates."""
        r = np.random.default_rng(seed)
        params = [*self.w, *self.b, self.o]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        acc = np.full(BUCKETS, 1e-6, np.float32)
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for s in range(0, len(x), batch):
                i = order[s : s + batch]
                xb, t = x[i], t + 1
                xb = np.where(r.random(xb.shape) < 0.12, 0, xb)  # words dropped, so that none decides alone
                empty = ~(xb > 0).any(1)
                xb[empty] = x[i][empty]
                words, at = np.unique(xb, return_inverse=True)
                at = at.reshape(xb.shape)
                p, where, wins = self.forward(self.word_vectors(table[words])[at], xb > 0)
                mask = (r.random(p.shape) < keep) / keep
                q = p * mask
                z = np.clip(q @ self.o + self.c, -30, 30)
                g = ((1 / (1 + np.exp(-z)) - y[i]) * weight[i] / len(i)).astype(np.float32)
                grad_o = q.T @ g + 1e-4 * self.o
                gp = (g[:, None] * self.o) * mask * (p > 0)
                gw, gb = [], []
                gh = np.zeros((len(i), WORDS, DIM), np.float32)
                rows = np.arange(len(i))[:, None]
                for k, width in enumerate(WIDTHS):
                    gk = gp[:, k * FILTERS : (k + 1) * FILTERS].astype(np.float32)
                    sel = wins[k][rows, where[k]]  # instance, filter, width * DIM
                    gw.append(np.einsum("bfd,bf->df", sel, gk) + 1e-5 * self.w[k])
                    gb.append(gk.sum(0))
                    back = gk[:, :, None] * self.w[k].T[None]
                    for j in range(width):
                        np.add.at(gh, (rows, where[k] + j), back[:, :, j * DIM : (j + 1) * DIM])
                for j, (pj, gj) in enumerate(zip(params, [*gw, *gb, grad_o])):
                    m[j] = 0.9 * m[j] + 0.1 * gj
                    v[j] = 0.999 * v[j] + 0.001 * gj * gj
                    pj -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
                self.c -= np.float32(rate * 2 * g.sum())
                gv = np.zeros((len(words), DIM), np.float32)
                np.add.at(gv, at.ravel(), gh.reshape(-1, DIM))
                hit = np.flatnonzero(np.abs(gv).sum(1) * (words > 0))
                if len(hit):
                    ids = table[words[hit]]
                    n = (ids > 0).sum(1)
                    flat, rep = ids.ravel(), np.repeat(np.arange(len(hit)), PIECES)
                    used = flat > 0
                    uniq, back = np.unique(flat[used], return_inverse=True)
                    ge = np.zeros((len(uniq), DIM), np.float32)
                    np.add.at(ge, back, (gv[hit] / np.sqrt(n)[:, None])[rep[used]])
                    acc[uniq] += (ge * ge).mean(1)
                    self.e[uniq] -= 0.05 * ge / np.sqrt(acc[uniq])[:, None]


def _instances(texts: list[str], enc: Encoder) -> list[list[tuple[str, ...]]]:
    return [list(dict.fromkeys(tuple(w) for s in split_sentences(t) for w in enc.windows(normalize(s)))) for t in texts]


def _grams(words: tuple[str, ...]) -> set[str]:
    return {*words, *(" ".join(p) for p in zip(words, words[1:])), *(" ".join(p) for p in zip(words, words[1:], words[2:]))}


SHRINK, CUT = 1.5, 0.25


def representatives(docs: list[list[tuple[str, ...]]], labels: np.ndarray) -> tuple[Counter, set[tuple[str, ...]]]:
    """(sentences of clean documents with counts, sentences that stand for documents labelled abusive).

    A sentence of an abusive document is judged by its words, pairs and triples of words: how much
    oftener other abusive documents have them than clean ones, shrunk towards no difference. The
    document's own occurrence does not count, so a document that shares nothing with other abusive
    ones, an annotator's slip, has no representative, and rare names prove nothing.
    """
    clean, dirty, known = Counter(), Counter(), Counter()
    for d, y in zip(docs, labels):
        (dirty if y else clean).update({g for s in d for g in _grams(s)})
        if not y:
            known.update(d)
    ratio = max(1, int(labels.sum())) / max(1, int((labels == 0).sum()))
    found: set[tuple[str, ...]] = set()
    for d, y in zip(docs, labels):
        if y:
            own = [(float(np.mean([np.log((dirty[g] - 1 + SHRINK) / (clean[g] * ratio + SHRINK)) for g in _grams(s)])), s) for s in d]
            best = max((v for v, _ in own), default=0.0)
            found.update(s for v, s in own if v >= CUT and v >= 0.4 * best)
    return known, found


def fit(docs: list[list[tuple[str, ...]]], labels: np.ndarray, enc: Encoder, epochs: int = 8, seed: int = 7) -> Net:
    """A net from documents given as sentences, with labels 0 or 1."""
    known, found = representatives(docs, labels)
    weight = Counter({s: min(n, 3) for s, n in known.items() if s not in found or n > 2})
    plain = list(dict.fromkeys([*weight, *sorted(found)]))
    y = [s in found and s not in weight for s in plain]
    w = [float(weight.get(s, 1)) for s in plain]
    sentences = list(plain)
    for i, s in enumerate(plain):  # some once more without blanks
        if zlib.crc32(" ".join(s).encode()) % 3 == 0 and len(s) > 1:
            glued = enc.windows(_chunks("".join(s)))
            sentences += [tuple(g) for g in glued]
            y += [y[i]] * len(glued)
            w += [1.0] * len(glued)
    y, w = np.array(y, np.float32), np.array(w, np.float32)
    pos, neg = max(1.0, float((w * y).sum())), max(1.0, float((w * (1 - y)).sum()))
    w = w * np.where(y == 1, min(12.0, max(1.0, neg / pos / 4)), 1.0).astype(np.float32)
    net = Net(seed)
    if y.any():
        x = enc([list(s) for s in sentences])
        net.fit(x, enc.table, y, w, epochs, seed=seed)
    return net


def language(lang: str | None, text: str | None) -> str:
    """ko, en or other, whatever the spelling of the label; by letters if there is none."""
    k = (lang or "").strip().lower()
    if k.startswith("ko"):
        return "ko"
    if k.startswith("en"):
        return "en"
    t = text or ""
    hangul = sum("가" <= c <= "힣" for c in t)
    latin = sum(c.isascii() and c.isalpha() for c in t)
    return "mixed" if hangul and latin > 0.3 * hangul and hangul > 0.1 * latin else "ko" if hangul >= latin else "en"


def best_threshold(score: np.ndarray, y: np.ndarray, default: float, slack: float = 0.01) -> float:
    """The cut nearest to one half whose F1 is within slack of the best; default if there are few positives."""
    if y.sum() < 8:
        return default
    cuts = np.linspace(0.2, 0.95, 31)
    picked = score[None, :] >= cuts[:, None]
    f1 = 2 * (picked & (y == 1)).sum(1) / (picked.sum(1) + y.sum())
    good = cuts[f1 >= f1.max() - slack]
    return float(good[np.abs(good - 0.5).argmin()])


class Model:
    def __init__(self, net: Net | None, thresholds: dict[str, float]):
        self.net, self.thresholds = net, thresholds
        self._forget()

    def _forget(self) -> None:
        self.enc, self.vectors, self.cache = Encoder(), np.zeros((0, DIM), np.float32), {}

    def __getstate__(self):
        return {"net": self.net, "thresholds": self.thresholds}

    def __setstate__(self, s):
        self.__init__(s["net"], s["thresholds"])

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        if self.net is None:
            return out
        docs = _instances([t or "" for t in texts], self.enc)
        if len(self.cache) > 100_000 or len(self.enc.numbers) > 200_000:
            self._forget()
        new = list({s for d in docs for s in d} - self.cache.keys())
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            x = self.enc([list(s) for s in part])
            fresh = self.enc.table[len(self.vectors) :]
            if len(fresh):
                self.vectors = np.concatenate([self.vectors, self.net.word_vectors(fresh)])
            self.cache.update(zip(part, self.net.scores(x, self.vectors).tolist()))
        for i, d in enumerate(docs):
            if d:
                out[i] = max(self.cache[s] for s in d)
        return out

    def threshold(self, lang: str) -> float:
        return self.thresholds.get(lang, self.thresholds.get("", 0.5))


def usable(rows: list[tuple]) -> list[tuple]:
    """Rows (id, text, language label, mean label) with text and a majority of annotators, by id."""
    return sorted((r for r in rows if r[1] and not r[1].isspace() and r[3] != 0.5), key=lambda r: r[0])


def fold_of(row: tuple) -> int:
    return zlib.crc32(str(row[0]).encode()) % 2


def fit_part(rows: list[tuple], unseen: int | None) -> tuple[Net | None, dict[int, float]]:
    """A net from the rows outside the fold unseen (None: from all), and its scores of that fold's documents."""
    labels = np.array([1 if r[3] > 0.5 else 0 for r in rows], int)
    enc = Encoder()
    docs = _instances([r[1] for r in rows], enc)
    at = [i for i, r in enumerate(rows) if unseen is None or fold_of(r) != unseen]
    if not at or labels[at].min() == labels[at].max():
        return None, {}
    net = fit([docs[i] for i in at], labels[at], enc)
    rest = [i for i, r in enumerate(rows) if unseen is not None and fold_of(r) == unseen]
    x = [enc([list(s) for s in docs[i]]) for i in rest]
    vectors = net.word_vectors(enc.table)
    return net, {rows[i][0]: float(net.scores(v, vectors).max()) if len(v) else 0.0 for i, v in zip(rest, x)}


def calibrated(rows: list[tuple], net: Net | None, unseen: dict[int, float]) -> Model:
    """The net with a threshold for each language, from scores of documents that the scoring net had not seen."""
    if net is None:
        return Model(None, {"": 1.1})
    labels = np.array([1 if r[3] > 0.5 else 0 for r in rows])
    score = np.array([unseen.get(r[0], 0.0) for r in rows])
    langs = np.array([language(r[2], r[1]) for r in rows])
    thresholds = {"": best_threshold(score, labels, 0.5)}
    for lang in set(langs.tolist()):
        thresholds[lang] = best_threshold(score[langs == lang], labels[langs == lang], thresholds[""])
    return Model(net, thresholds)


def train(rows: list[tuple[int, str | None, str | None, float]]) -> Model:
    """rows: id, text, language label, mean label."""
    rows = usable(rows)
    seen = fit_part(rows, 0)[1] | fit_part(rows, 1)[1]
    return calibrated(rows, fit_part(rows, None)[0], seen)


def trained(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model from at most max_labelled labelled documents. Its three nets are three tasks."""
    per = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.avg(F.col("toxic").cast("double")).alias("label"))
    sample = materialize(per.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = materialize(documents.select("doc_id", "text", "lang").join(sample, "doc_id").dropDuplicates(["doc_id"]))  # max_labelled rows

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        own = usable([(r.doc_id, r.text, r.lang, r.label) for r in pdf.itertuples()])
        part = int(pdf.part.iloc[0])
        net, unseen = fit_part(own, None if part == 2 else part)
        out = [(k, v, None) for k, v in unseen.items()]
        if part == 2:
            out.append((None, None, pickle.dumps(net)))
        return pd.DataFrame(out, columns=["doc_id", "score", "net"]).astype({"doc_id": "Int64", "score": float, "net": object})

    each = rows.withColumn("part", F.explode(F.array(*map(F.lit, (0, 1, 2))))).repartitionByRange(3, "part")
    done = each.groupBy("part").applyInPandas(work, "doc_id bigint, score double, net binary").collect()  # a score a document of the sample, and one net
    net = next((pickle.loads(r.net) for r in done if r.net is not None), None)
    return calibrated(usable([(r.doc_id, r.text, r.lang, r.label) for r in rows.collect()]), net, {r.doc_id: r.score for r in done if r.net is None})


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, source, language, score, found."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in batches:
            for i in range(0, len(big), 400):
                b = big.iloc[i : i + 400]
                score = shared.value.score(b.text.tolist())
                langs = [language(x, t) for x, t in zip(b.lang, b.text)]
                found = score >= np.array([shared.value.threshold(x) for x in langs])
                yield pd.DataFrame({"doc_id": b.doc_id.to_numpy(), "source": b.source.to_numpy(), "language": langs, "score": score, "found": found})

    return documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source").mapInPandas(run, "doc_id bigint, source string, language string, score double, found boolean")
