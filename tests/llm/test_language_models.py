"""Language identification and the Kneser-Ney classifier."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import SF_DIR
from tabaudit.llm import frames, kneser_ney, language_id


def plain_grams(text):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " ".join(clean.split(" ")).strip()
    while "  " in clean:
        clean = clean.replace("  ", " ")
    if not clean:
        return [0, 0, 0]
    padded = f" {clean} "
    return [len(clean), len(padded) - 1, len(padded) - 2]


def test_hashed_grams_by_text():
    texts = ["Ab c", None, "", "12 !", "é", "x" * 5000, "ab  C"]
    alone = [[f[s[0] : s[1]].tolist() for f, s in language_id.hashed_grams(pa.array([t], pa.string()))] for t in texts]
    for n, (features, starts) in enumerate(language_id.hashed_grams(pa.array(texts))):
        for i, text in enumerate(texts):
            own = features[starts[i] : starts[i + 1]].tolist()
            assert own == alone[i][n] and len(own) == plain_grams(text or "")[n]
    assert alone[0] == alone[6]


def test_language_prediction(spark, documents):
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(documents.filter(~held_out))
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "1 2 3 !"), (4, "the " * 60_000), (None, "the and of"), (4, "the " * 60_000)],
        "doc_id long, text string",
    )
    rows = model.predict(documents).join(documents.select("doc_id", "lang"), "doc_id").withColumn("held", held_out)
    share = rows.filter("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    got = [(r.doc_id, r.lang_pred, r.score) for r in model.predict(odd).collect()]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(k, "und", 0.0) for k in (1, 2, 3)]
    assert len({g for g in got if g[0] == 4}) == 1 and len(got) == 6
    assert all(0 <= g[2] <= 1 for g in got)
    nothing = language_id.fit(documents.limit(0))
    assert {r.lang_pred for r in nothing.predict(odd).collect()} == {"und"}
    assert model.predict(odd.limit(0)).count() == 0


def test_scores_are_mean_weights():
    """The vectorised score is the weight of each n-gram times its share."""
    rng = np.random.default_rng(0)
    model = language_id.LanguageModel(["a", "b"], rng.normal(size=(1 << 10, 2)), np.array([0.1, -0.2]), 1.0)
    texts = ["Hello there world", "été", "zz top"]
    logits, known = model.logits(pa.array(texts))
    assert known.all()
    for text, row in zip(texts, logits):
        grams = np.concatenate([f for f, _ in language_id.hashed_grams(pa.array([text]), 10)])
        assert np.allclose(row, language_id.SCALE * model.weights[grams].mean(axis=0) + model.bias)


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        label = int(rng.integers(2))
        noise = rng.choice(np.arange(10, 200), 5, replace=False)
        rows.append((label, np.concatenate([[label], noise]), np.array([1.0] + [0.02] * 5)))
    weights = language_id.ftrl(rows, 200, 2)
    assert weights[0, 0] > weights[0, 1] and weights[1, 1] > weights[1, 0]
    assert (weights[10:] == 0).mean() > 0.5


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    true = rng.normal(size=(5000, 3)) * 2
    shares = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=p) for p in shares])
    assert abs(language_id.temperature(true * 4, labels) - 4) < 0.4


class PlainKneserNey:
    """Modified Kneser-Ney with dictionaries."""

    def __init__(self, texts, order=kneser_ney.ORDER):
        self.order = order
        counts = Counter()
        for t in texts:
            padded = kneser_ney.START * (order - 1) + t
            counts.update(padded[i : i + order] for i in range(len(t)))
        self.tables = {}
        for n in range(order, 0, -1):
            if n < order:
                counts = Counter(g[1:] for g in counts)
            of = Counter(counts.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.0
            d = [0.5, 1.0, 1.5]
            for k in (1, 2, 3):
                estimate = k - (k + 1) * y * of[k + 1] / of[k] if of[k] else 0
                if 0 < estimate < k:
                    d[k - 1] = estimate
            total, left = Counter(), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3) - 1]
            self.tables[n] = (counts, d, total, left)
        self.letters = len(self.tables[1][0])

    def chance(self, gram):
        p = 1 / (self.letters + 1)
        for n in range(1, self.order + 1):
            counts, d, total, left = self.tables[n]
            g = gram[self.order - n :]
            if total[g[:-1]]:
                c = counts[g]
                p = (c - (d[min(c, 3) - 1] if c else 0) + left[g[:-1]] * p) / total[g[:-1]]
        return p

    def loss(self, text):
        padded = kneser_ney.START * (self.order - 1) + text
        return -sum(math.log(self.chance(padded[i : i + self.order])) for i in range(len(text)))


@pytest.fixture(scope="module")
def judged_docs(documents, make_docs):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.filter("n_chars < 3000").limit(60).collect()]
    rows += [(5000, None, "en", "s"), (5001, "", None, "s"), (None, "null id \U0001f600", None, "s"), (5002, "xy " * 9000, "zz", "s")]
    return make_docs(rows + rows[:2])


def test_perplexity_matches_plain_model(spark, judged_docs, monkeypatch):
    rows = judged_docs.select("doc_id", "text", "lang")
    trusted = judged_docs.filter("doc_id < 5000").select("doc_id")
    learned = trusted.filter(~frames.held_out(F.col("doc_id"), kneser_ney.HELD_OUT_BELOW))
    ids = {r[0] for r in learned.collect()}
    model = PlainKneserNey([r.text for r in rows.collect() if r.doc_id in ids and r.text])
    got = sorted((r.doc_id or -1, r.n_chars, round(r.loss, 5)) for r in kneser_ney.perplexities(rows, trusted).collect())
    want = sorted((r.doc_id or -1, len(r.text or ""), round(model.loss(r.text or ""), 5)) for r in rows.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-6)
    # Probabilities of all continuations of a context add up to 1, the unseen character included.
    letters = list(model.tables[1][0]) + ["￿"]
    for context in ("the", "zzz", kneser_ney.START * 3):
        assert abs(sum(model.chance(context + x) for x in letters) - 1) < 1e-9


@pytest.mark.parametrize(
    "text",
    [
        "aaabaaabaaabxaaabqqqqqqq",  # raw discounts that are not positive
        "abcdefgh",  # all occur once: no counts of two
        "ababababab cdcdcdcdcd " * 4,  # raw discounts below zero at two and three
        "z",
    ],
)
def test_every_probability_is_positive(spark, make_docs, monkeypatch, text):
    ids = iter(i for i in range(100) if hashlib.md5(str(i).encode()).hexdigest()[0] >= kneser_ney.HELD_OUT_BELOW)
    docs = make_docs([(next(ids), text), (next(ids), "unseen: " + text[::-1] + "\u4e2d")]).select("doc_id", "text", "lang")
    trusted = docs.filter(F.col("text") == text).select("doc_id")
    model = PlainKneserNey([text])
    rows = kneser_ney.perplexities(docs, trusted).collect()
    assert len(rows) == 2 and all(math.isfinite(r.loss) for r in rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert np.allclose([r.loss for r in rows], [model.loss(texts[r.doc_id]) for r in rows])
    letters = [*model.tables[1][0], "\u4e2d"]
    contexts = {g[:-1] for n in range(1, 5) for g in model.tables[n][0]}
    for context in contexts:
        chances = [model.chance((context + x).rjust(4, "\u4e2e")) for x in letters]
        assert min(chances) > 0 and sum(chances) == pytest.approx(1)


def test_grams_of_any_alphabet():
    everything = "".join(chr(c) for c in range(0x20, 0x20000) if not 0xD800 <= c < 0xE000)
    for texts in (["abab", "", "😀é", "a"], [everything, "abc" + everything[-50:]]):
        found, grams, starts = kneser_ney._grams(texts)
        padded = [kneser_ney.START * 3 + t for t in texts]
        want = [p[i : i + 4] for p, t in zip(padded, texts) for i in range(len(t))]
        assert [grams[f] for f in found] == want and len(set(grams)) == len(grams)
        assert np.diff(starts).tolist() == [len(t) for t in texts]


def test_judgement(spark, judged_docs):
    trusted = judged_docs.filter("doc_id < 5000").select("doc_id")
    out = {r.doc_id: r for r in kneser_ney.judge(judged_docs, trusted).collect()}
    assert not out[5000].kept and out[5000].perplexity is None and not out[5001].kept
    assert out[5002].threshold > 0
    nobody = trusted.limit(0)
    rows = kneser_ney.judge(judged_docs, nobody).collect()
    assert len(rows) == judged_docs.count()
    assert all(r.kept == (r.n_chars > 0) for r in rows)
    assert kneser_ney.judge(judged_docs.limit(0), trusted).count() == 0


def test_threshold_is_the_quantile_of_held_out_text(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = kneser_ney.judge(docs, labels.filter("quality = 1").select("doc_id"))
    held = frames.held_out(F.col("doc_id"), kneser_ney.HELD_OUT_BELOW).alias("held")
    rows = judged.join(labels, "doc_id").select("*", held).collect()
    by_lang = defaultdict(list)
    for r in rows:
        if r.quality == 1 and r.held and r.perplexity:
            by_lang[r.lang].append((r.perplexity, r.threshold, r.kept))
    assert by_lang
    for found in by_lang.values():
        found.sort()
        quantile = found[math.ceil(kneser_ney.QUANTILE * len(found)) - 1][0]
        assert quantile <= found[0][1] <= quantile * math.exp(2 * kneser_ney.LOSS_BIN)
        assert sum(not kept for *_, kept in found) <= (1 - kneser_ney.QUANTILE) * len(found)
    poor = [r.kept for r in rows if r.quality == 0]
    assert sum(not kept for kept in poor) / len(poor) > 0.93


def test_languages_of_few_documents_are_learned(spark):
    rare = "ξένη γλώσσα με δικά της γράμματα"
    place = F.pmod(F.xxhash64(F.lit(rare), F.col("id")), F.lit(4))
    # An id with which the only document would be kept back.
    alone = spark.range(1000, 1100).filter(place == 0).first()[0]
    rows = [(i, f"plain words number {'abcdefgh'[i % 8] * 3} of the common language", "aa") for i in range(60)]
    docs = spark.createDataFrame([*rows, (alone, rare, "zz")], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == ["aa", "zz"]
    found = {r.doc_id: r.lang_pred for r in model.predict(docs).collect()}
    assert found[alone] == "zz" and found[0] == "aa"
