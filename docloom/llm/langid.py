"""Language identification by hierarchical discrimination: family first, then languages inside it.

Features are hashed byte trigrams of folded letters (other bytes are one gap), as shares of a text's
trigrams. At each node (the families; the languages of one family) one linear support vector machine
stands for each pair; the child with the most pairwise probability wins. Machines are fitted by dual
coordinate descent on at most about ``per_language`` texts of each language (a hash threshold on doc_id
decides), and their margins are turned to probabilities on those texts. Prediction reads whole texts.

The machines only tell languages apart. So the score is the probability of the two choices times the fit of
the text to the chosen language: the mean log probability of its trigrams there, over that of equally likely
trigrams, plus its standard error, as a share of the median that held-back halves of the learnt texts reach,
from 0 to 1. Other languages, random letters and encoded data come out near 0. A language whose halves say
nothing of each other (one or few texts) has fit 1.

Every language that occurs is learnt; machines grow with the square of the languages in a node. A label's family is that
of its first subtag (``en-GB`` is germanic); a language that no family names is a family of its own.

Only text and non-null lang of rows whose crc32(doc_id as text) mod 5 is not 0 are learnt from.

Defined results: null text and text without a letter are ``und`` with score 0; without any row to learn from
so is every text; a null doc_id is never learnt from and counts as held out; repeated rows get equal results, and rows
that share doc_id and lang are learnt from once, by the text with the least hash; a tie of votes goes to the child that
is first by name; very long texts are read whole; an empty table gives an empty result; other columns are kept by
``identify``, whatever their names, and ignored by ``identify_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import ship, with_arrow_columns
from docloom.llm.words import buffers

#: Language families (fixed values); a language that is not named is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk", "pl", "cs", "sk"],
    "turkic": ["tr", "az", "kk", "uz"],
    "uralic": ["fi", "et", "hu"],
    "indic": ["hi", "bn", "mr", "ur", "ne"],
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    """The family of a language label: that of its first subtag, else the label itself."""
    return _FAMILY.get(re.split(r"[-_]", lang.strip().lower())[0], lang)


DIMS = 4096
#: Texts whose trigram counts a task holds at once.
ROWS = 256
#: Texts that all languages are learnt from (the driver holds their shares), and the least for each of many languages.
SAMPLE, LEAST = 28_000, 30

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def held_out(doc_id: Column) -> Column:
    """Whether a row may not be learnt from: crc32(doc_id as text) mod 5 is 0, or doc_id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def trigrams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that ends at each byte (the first two see gaps)."""
    x = _FOLD[data]
    if len(x) > 1:  # Latin-1 capitals behind 0xC3 fold, too
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        x[1:][capital] += 0x20
    x = x.astype(np.uint32)
    h = x * np.uint32(0x9E3779B1)
    h[1:] += x[:-1] * np.uint32(0x85EBCA77)
    h[2:] += x[:-2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(20)


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for r in np.flatnonzero(~found):
        found[r] = has_letter(data[offsets[r] : offsets[r + 1]].tobytes())
    return found


# --- fitting ------------------------------------------------------------------------------------------


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 12, rows: np.ndarray | None = None, norms: np.ndarray | None = None) -> np.ndarray:
    """A linear machine with squared hinge loss (weights, then the bias), by dual coordinate descent; classes weigh alike.

    ``rows`` are the rows of ``x`` that ``y`` is about (all, if not told); they are not copied. ``norms`` are the squared
    norms of all rows of ``x``, if they are known.
    """
    rows = np.arange(len(x)) if rows is None else rows
    rng = np.random.default_rng(7)
    w, bias = np.zeros(x.shape[1], np.float64), 0.0
    share = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum()))
    diag = 0.5 / (cost * share)
    norm = (np.einsum("ij,ij->i", x, x) if norms is None else norms)[rows] + 1.0 + diag
    alpha = np.zeros(len(y))
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            row = x[rows[i]]
            gradient = y[i] * (row @ w + bias) - 1 + diag[i] * alpha[i]
            new = max(alpha[i] - gradient / norm[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += step * row
                bias += step
                alpha[i] = new
    return np.append(w, bias)


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton steps."""
    a, b = 1.0, 0.0
    goal = np.where(y > 0, 1 - 1 / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - goal) * margin).sum() + 1e-3 * a, (p - goal).sum()])
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


@dataclass
class Model:
    """Machines of all nodes side by side; a node lists its children and its (first, second, machine) pairs."""

    weights: np.ndarray
    bias: np.ndarray
    curve: np.ndarray
    families: list[str]
    languages: dict[str, list[str]]
    nodes: dict[str, list[tuple[int, int, int]]]
    typical: dict[str, tuple[np.ndarray, float, float]]  # log probability by trigram, its deviation, usual mean (0: unknown)

    def _fit(self, name: str, shares: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How well texts fit a language, from 0 to 1."""
        logs, deviation, usual = self.typical[name]
        if usual <= 0:
            return np.ones(len(shares))
        return np.clip((shares @ logs + deviation / np.sqrt(n)) / usual, 0.0, 1.0)

    def _choose(self, node: str, children: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child with the most pairwise probability, and its mean probability."""
        votes = np.zeros((len(p), children))
        for a, b, m in self.nodes[node]:
            votes[:, a] += p[:, m]
            votes[:, b] += 1 - p[:, m]
        best = votes.argmax(axis=1)
        return best, votes[np.arange(len(p)), best] / max(1, children - 1) if children > 1 else np.ones(len(p))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        rows = len(offsets) - 1
        names, score = np.full(rows, "und", object), np.zeros(rows)
        ok = _lettered(data, offsets)
        if not self.families or not ok.any():
            return names.tolist(), score
        h = trigrams(data).astype(np.int64)
        for start in range(0, rows, ROWS):  # counts of a few texts at once, however long and however many machines
            end = min(rows, start + ROWS)
            sizes = np.diff(offsets[start : end + 1])
            at = np.repeat(np.arange(end - start) * DIMS, sizes) + h[offsets[start] : offsets[end]]
            n = np.maximum(sizes, 1)
            shares = (np.bincount(at, minlength=(end - start) * DIMS).reshape(-1, DIMS) / n[:, None]).astype(np.float32)
            self._predict(shares, n, ok[start:end], names[start:end], score[start:end])
        return names.tolist(), np.clip(score, 0.0, 1.0)

    def _predict(self, shares: np.ndarray, n: np.ndarray, ok: np.ndarray, names: np.ndarray, score: np.ndarray) -> None:
        """Fills in names and scores of the texts that are ``ok``."""
        margin = shares @ self.weights + self.bias
        p = 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -30, 30)))
        family, sure = self._choose("", len(self.families), p)
        for f, name in enumerate(self.families):
            at = np.flatnonzero(ok & (family == f))
            if len(at):
                best, more = self._choose(name, len(self.languages[name]), p[at])
                for k, lang in enumerate(self.languages[name]):
                    on = at[best == k]
                    if len(on):
                        names[on] = lang
                        score[on] = sure[on] * more[best == k] * self._fit(lang, shares[on], n[on])


def _logs(shares: np.ndarray) -> np.ndarray:
    """Log probability of each trigram in texts, over that of equally likely ones; one more text has all alike.

    Trigrams of gaps alone (digits, signs) speak for no language.
    """
    logs = np.log((shares.sum(axis=0, dtype=np.float64) * DIMS + 1) / (len(shares) + 1)).astype(np.float32)
    logs[trigrams(np.frombuffer(b"   ", np.uint8))[2]] = 0
    return logs


def _typical(shares: np.ndarray) -> tuple[np.ndarray, float, float]:
    logs = _logs(shares)
    p = np.exp(logs.astype(np.float64)) / DIMS
    deviation = float(np.sqrt(max(0.0, p @ logs.astype(np.float64) ** 2 - (p @ logs) ** 2)))
    if len(shares) < 2:
        return logs, deviation, 0.0
    means = np.concatenate([shares[::2] @ _logs(shares[1::2]), shares[1::2] @ _logs(shares[::2])])
    return logs, deviation, float(np.median(means))


def fit(langs: list[str], shares: np.ndarray) -> Model:
    """A model from texts' trigram shares (one row of DIMS a text)."""
    known = sorted(set(langs))
    families = sorted({family_of(x) for x in known})
    languages = {f: [x for x in known if family_of(x) == f] for f in families}
    typical = {v: _typical(shares[np.array(langs, object) == v]) for v in known}
    scale = (1 / np.sqrt(shares.mean(axis=0) + 1e-6)).astype(np.float32) if len(shares) else np.ones(DIMS, np.float32)
    x = shares
    x *= scale  # in place: the driver holds the sample once
    lang = np.array(langs, object)
    family = np.array([family_of(v) for v in langs], object)
    machines, curves, nodes = [], [], {}
    norms = np.einsum("ij,ij->i", x, x)  # once for all machines

    def node(name: str, labels: np.ndarray, children: list[str]) -> None:
        nodes[name] = []
        for a, b in combinations(range(len(children)), 2):
            at = np.flatnonzero((labels == children[a]) | (labels == children[b]))
            y = np.where(labels[at] == children[a], 1.0, -1.0)
            w = fit_svm(x, y, rows=at, norms=norms)
            curves.append(_platt(x[at] @ w[:-1].astype(np.float32) + w[-1], y))
            nodes[name].append((a, b, len(machines)))
            machines.append(w)

    node("", family, families)
    for f in families:
        node(f, lang, languages[f])
    w = np.array(machines).reshape(-1, DIMS + 1)
    return Model(np.ascontiguousarray((w[:, :-1] * scale).T.astype(np.float32)), w[:, -1], np.array(curves).reshape(-1, 2).T, families, languages, nodes, typical)


def _shares(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels and trigram shares of the rows to learn from (bounded by the sample), in an order of their own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, data, offsets in buffers(batch.column("text")):
                h = trigrams(data)
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    n = np.bincount(h[a:b], minlength=DIMS)
                    on = np.flatnonzero(n)
                    out.append(on.astype("<u2").tobytes() + n[on].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.binary())], names=["lang", "counts"])

    found = rows.select("lang", "text").mapInArrow(count, "lang string, counts binary").collect()
    found.sort(key=lambda r: (r["lang"], r["counts"]))  # rows come in any order
    shares = np.zeros((len(found), DIMS), np.float32)
    for i, r in enumerate(found):
        raw = bytes(r["counts"])
        n = len(raw) // 6
        at, times = np.frombuffer(raw, "<u2", n), np.frombuffer(raw, "<u4", n, 2 * n)
        shares[i, at] = times / max(1, int(times.sum()))
    return [r["lang"] for r in found], shares


def learn(docs: DataFrame, per_language: int = 700) -> Model:
    """Fits on at most about ``per_language`` texts of every language, fewer if all would be over SAMPLE (but LEAST)."""
    ship(docs.sparkSession)
    open_ = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = open_.groupBy("lang").count().collect()
    if not counts:
        return fit([], np.zeros((0, DIMS), np.float32))
    per_language = min(per_language, max(LEAST, SAMPLE // len(counts)))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(2**53)
    rate = F.create_map(*[F.lit(x) for r in sorted(counts, key=lambda r: r["lang"]) for x in (r["lang"], min(1.0, per_language / r["count"]))])
    # a row for each doc_id at most, so repeated rows do not lift the bound
    chosen = open_.where(draw < rate[F.col("lang")]).groupBy("lang", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return fit(*_shares(chosen))


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """All columns of ``docs`` with the language and its score under names that ``docs`` does not have (see free_name)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMS floats for each pair of languages

    def make():
        model = sent.value

        def compute(column: pa.Array) -> list[pa.Array]:
            langs, scores = [], []
            for _, data, offsets in buffers(column, 1 << 20):
                found, sure = model.predict(data, offsets)
                langs += found
                scores.append(sure)
            return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]

        return compute

    return with_arrow_columns(docs, "text", make, [(lang, "string"), (score, "double")])


def identify_documents(docs: DataFrame, per_language: int = 700) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents, learnt from the documents that are not held out."""
    model = learn(docs, per_language)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = identify(rows, model)
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
