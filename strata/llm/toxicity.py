"""Toxicity: a linear classifier over words, regularised by counterfactual identity swaps.

Training rows are labelled documents with a known label whose id hashes into four fifths
(crc32 mod 5 is not 0), the ``MAX_LABELLED`` of lowest hash if there are more (a documented
bound on labelled rows). Spark counts in how many toxic and other ones each word occurs;
the ``VOCABULARY`` words with the largest chi-square, and all identity terms, are the
features (present or not). Each training text that names an identity group yields
counterfactuals: the text with the term swapped for each other one of its family. The
logistic loss is penalised by the squared change of the linear score under those swaps, so
that naming a group, whichever, moves the score alike and neutral mentions stay neutral.

Null, empty and wordless texts get the score of the bias alone. Null labels and ids teach
nothing; of a repeated label the toxic one holds, repeated rows count each. Texts are read
whole. Other columns are ignored, an empty table gives an empty result. Without both labels among the training rows the score is their smoothed share of
toxic labels. A word is a run of letters, digits and apostrophes in lower case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents, texts

MAX_LABELLED, VOCABULARY, MIN_DOCS = 65_536, 512, 3
RIDGE, SWAP_PENALTY = 0.05, 10.0
#: Families of identity terms, of one language, number and gender each; a term is
#: swapped for the others of its family. A word stands in one family only.
IDENTITIES = (
    # English
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("gays", "lesbians", "bisexuals"),
    ("black", "white", "asian", "latino"), ("blacks", "whites", "asians", "latinos"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf"),
    # German
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"),
    ("schwul", "lesbisch", "bisexuell", "heterosexuell"), ("schwule", "lesben", "heterosexuelle"),
    ("einwanderer", "flüchtling", "einheimischer"), ("migranten", "flüchtlinge", "einheimische"),
    ("behindert", "gehörlos", "taub"), ("behinderte", "gehörlose", "blinde"),
    # French
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmane", "chrétienne", "juive", "hindoue"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("fille", "garçon"),
    ("homosexuel", "hétérosexuel", "bisexuel"), ("homosexuels", "hétérosexuels", "bisexuels"),
    ("immigré", "réfugié", "autochtone"), ("immigrés", "réfugiés", "autochtones"),
    ("handicapé", "aveugle", "sourd"), ("handicapés", "aveugles", "sourds"),
    # Spanish
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmana", "cristiana", "judía", "atea"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("chicas", "chicos"), ("chica", "chico"),
    ("homosexual", "heterosexual"), ("homosexuales", "heterosexuales", "bisexuales"),
    ("inmigrante", "refugiado", "nativo"), ("inmigrantes", "refugiados", "nativos"),
    ("discapacitado", "ciego", "sordo"), ("discapacitados", "ciegos", "sordos"),
)
_WORD = re.compile(r"[\w']+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def swaps(own: set[str], families=IDENTITIES) -> list[tuple[str, str | None]]:
    """(word that goes, word that comes) for each identity term of a text and each other one of
    its family; None comes where the text has that word already."""
    return [(term, other if other not in own else None)
            for family in families for term in family if term in own
            for other in family if other != term]


def training_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                  most: int) -> DataFrame:
    """(text, toxic) of the labelled rows to learn from."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = (known.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
             .select(F.col("doc_id").alias("_id"), "toxic"))
    return (df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(known), "_id").select("text", "toxic"))


def vocabulary(rows: DataFrame, families=IDENTITIES) -> tuple[list[str], int, int]:
    """The feature words, and the numbers of toxic and other training rows."""

    def count(batches):
        toxic, other = Counter(), Counter()
        for batch, bodies in texts(batches, "text"):
            for text, mark in zip(bodies, batch.column(1).to_pylist()):
                side = toxic if mark else other
                side[""] += 1
                side.update(words(text))
        every = list(toxic.keys() | other.keys())
        for at in range(0, len(every), 50_000):
            some = every[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([toxic[w] for w in some]),
                 pa.array([other[w] for w in some])], names=["word", "toxic", "other"])

    scratch = Scratch(rows.sparkSession, "toxicity")
    counts = scratch.stage(
        rows.mapInArrow(count, "word string, toxic long, other long").groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
        .filter((F.col("a") + F.col("b") >= MIN_DOCS) | (F.col("word") == "")), "words")
    size = counts.filter("word = ''").first()
    n_toxic, n_other = (int(size["a"]), int(size["b"])) if size else (0, 0)
    if not n_toxic or not n_other:
        return [], n_toxic, n_other
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    gap = a * n_other - b * n_toxic
    chi = gap * gap / ((a + b) * (n_toxic + n_other - a - b) + 1.0)
    top = (counts.filter("word <> ''").orderBy(F.desc(chi), "word").limit(VOCABULARY)
           .select("word").collect())
    scratch.close()
    named = {t for family in families for t in family}
    return sorted({r["word"] for r in top} | named), n_toxic, n_other


def features(rows: DataFrame, vocab: list[str], families=IDENTITIES) -> pd.DataFrame:
    """Distinct feature sets with their counts, (toxic, own, null, n), and the swaps by the words
    that go and come, (-1, word, word or none, n): there are no more of those than pairs in
    families, however many texts name a group, as a swap moves the linear score by its two
    words alone."""
    index = {w: i for i, w in enumerate(vocab)}

    def encode(batches):
        for batch, bodies in texts(batches, "text"):
            out = Counter()
            for text, mark in zip(bodies, batch.column(1).to_pylist()):
                all_words = words(text)
                own = sorted(index[w] for w in all_words & index.keys())
                out[(mark, ",".join(map(str, own)), None)] += 1
                for gone, come in swaps(all_words, families):
                    out[(-1, str(index[gone]), str(index[come]) if come else "")] += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in out], pa.int32()), pa.array([k[1] for k in out]),
                     pa.array([k[2] for k in out], pa.string()), pa.array(list(out.values()))],
                    names=["toxic", "own", "swapped", "n"])

    return (rows.mapInArrow(encode, "toxic int, own string, swapped string, n long")
            .groupBy("toxic", "own", "swapped").agg(F.sum("n").alias("n"))).toPandas()


def _matrix(sets, width: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.fromiter(map(int, s.split(",")), np.int64) if s else np.zeros(0, np.int64)
             for s in sets]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return row, np.concatenate(parts) if parts else np.zeros(0, np.int64)


def fit(data: pd.DataFrame, width: int, ridge: float = RIDGE,
        swap_penalty: float = SWAP_PENALTY) -> np.ndarray:
    """Weights, the bias last: Newton steps on the penalised logistic loss, solved by CG."""
    plain = data[data["swapped"].isna()].sort_values(["toxic", "own"])
    pairs = data[data["swapped"].notna()].sort_values(["toxic", "own", "swapped"])
    y, n = plain["toxic"].to_numpy(float), plain["n"].to_numpy(float)
    row, col = _matrix(plain["own"], width)
    ro, co = _matrix(pairs["own"], width)
    rs, cs = _matrix(pairs["swapped"], width)
    m = pairs["n"].to_numpy(float) * swap_penalty

    def forward(w):
        return np.bincount(row, w[col], minlength=len(y)) + w[width]

    def back(v):
        return np.append(np.bincount(col, v[row], minlength=width), v.sum())

    def change(w):
        return (np.bincount(ro, w[co], minlength=len(m))
                - np.bincount(rs, w[cs], minlength=len(m)))

    def change_back(v):
        return np.append(np.bincount(co, v[ro], minlength=width)
                         - np.bincount(cs, v[rs], minlength=width), 0.0)

    hold = np.append(np.full(width, ridge), 1e-6)
    w = np.zeros(width + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        slope = back(n * (p - y)) + hold * w + change_back(m * change(w))
        curve = n * p * (1 - p)
        step, res = np.zeros_like(w), -slope
        way, norm = res.copy(), res @ res
        for _ in range(60):
            if norm < 1e-10 * max(1.0, slope @ slope):
                break
            bent = back(curve * forward(way)) + hold * way + change_back(m * change(way))
            a = norm / (way @ bent)
            step, res = step + a * way, res - a * bent
            norm, old = res @ res, norm
            way = res + norm / old * way
        w = w + step
        if np.abs(step).max(initial=0.0) < 1e-6:
            break
    return w


class Scorer:
    """``score(text)`` between 0 and 1."""

    def __init__(self, weight: dict[str, float], bias: float):
        self.weight, self.bias = weight, bias

    def score(self, text: str | None) -> float:
        own = self.weight.keys() & words(text)
        z = self.bias + sum(self.weight[w] for w in sorted(own))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          families=IDENTITIES, most: int = MAX_LABELLED) -> Scorer:
    rows = training_rows(df, labels, id_col, text_col, most)
    vocab, n_toxic, n_other = vocabulary(rows, families)
    if not vocab:
        return Scorer({}, float(np.log((n_toxic + 1) / (n_other + 1))))
    w = fit(features(rows, vocab, families), len(vocab))
    return Scorer(dict(zip(vocab, w.tolist())), float(w[-1]))


def score_toxicity(spark: SparkSession, df: DataFrame, labels: DataFrame,
                   id_col: str = "doc_id", text_col: str = "text",
                   model: Scorer | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, score, predicted."""
    model = model or train(df, labels, id_col, text_col)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.score(t) for t in part], dtype="float64")

    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    return (df.select(F.col(id_col).alias("doc_id"), held.alias("held_out"),
                      score(F.col(text_col).cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(spark, documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
