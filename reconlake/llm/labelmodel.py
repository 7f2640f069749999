"""Matching entities across sources without keys (problem 3).

Method: many heuristic functions vote on each candidate pair (sound of the name, area, type, corporation, brand, address
relation, prefecture, and whether the name is as like as that relation needs); a generative model with a hidden match variable learns from the votes alone how accurate each
function is and which of them go together, and gives each pair a posterior. As a row describes at most one facility, the
posterior odds of the facilities it could mean are weighed against each other; what results is the confidence, and it
alone decides.

The model sees distinct vote patterns with their counts (at most MAX_PATTERNS rows, else it is refused), not pairs:
expectation maximisation over categorical votes, abstentions included. Functions whose votes are correlated beyond
what the first estimate of the match variable explains (conditional mutual information) are joined to one factor, all that
hang together, before the model is learned.

Rows without a usable name get no match. Repeated rows are judged once and each get their matches. Empty tables
give none; without variety in the votes the posterior stays at the prior of the rules.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm import names
from reconlake.session import cut, joined, ship_package

MAX_PATTERNS = 100_000
ROUNDS = 60
CORRELATED = 0.7  # share of its uncertainty that one function must tell of another, given the match variable, to be one factor
PRIOR = 20.0  # pseudo-pairs by which the rules speak for each factor; they decide only where data are few
CONFIDENT = 0.65

FUNCTIONS = ("name", "area", "types", "corp", "brand", "place", "pref", "fits")


def votes_of(p: DataFrame) -> DataFrame:
    """Pairs of names.sided() with the vote of each function; '' where it abstains."""

    def same(k: str):
        l, r = F.col(f"a_{k}"), F.col(f"b_{k}")
        return F.when((l == "") | (r == ""), "").when(l == r, "same").otherwise("differ")

    distance = F.levenshtein("a_snd", "b_snd") / F.greatest(F.length("a_snd"), F.length("b_snd"))
    name = F.when(distance == 0, "equal").when(distance <= 0.13, "close").when(distance <= 0.25, "near").when(distance <= 0.45, "like").otherwise("unlike")
    kinds = F.arrays_overlap(F.split("a_types", r"\+"), F.split("b_types", r"\+"))
    types = F.when((F.col("a_types") == "") | (F.col("b_types") == ""), "").when(kinds, "same").otherwise("differ")
    fits = F.lit(False)
    for relation, least in names.LEAST.items():
        fits = fits | ((F.col("relation") == relation) & (F.col("score") >= least))
    p = p.select(
        "a", "b", "score", name.alias("name"), same("area").alias("area"), types.alias("types"), same("corp").alias("corp"),
        same("brand").alias("brand"), F.col("relation").alias("place"), same("pref").alias("pref"), F.when(fits, "fits").otherwise("short").alias("fits"),
    )
    return p


class LabelModel:
    """Latent class model of categorical votes, learned from pattern counts."""

    def __init__(self, patterns: list[tuple[str, ...]], counts: np.ndarray) -> None:
        self.n = counts.astype(float)
        self.columns = [list(c) for c in zip(*patterns, strict=True)]
        self.names = [(i,) for i in range(len(self.columns))]
        self.factors = [self._codes(g) for g in self.names]

    def _codes(self, group: tuple[int, ...]) -> np.ndarray:
        keys = list(zip(*[self.columns[i] for i in group], strict=True))
        index = {k: i for i, k in enumerate(sorted(set(keys)))}
        return np.array([index[k] for k in keys])

    #: how far each vote speaks for a match before anything is learned (log odds)
    PRO = {"equal": 2.0, "close": 1.5, "near": 0.3, "like": -1.5, "unlike": -3.0, "same": 0.5, "differ": -1.0,
               "full": 4.0, "part": 2.5, "city": 1.0, "slip": 1.0, "open": -0.5, "apart": -5.0, "fits": 0.5, "short": -4.0, "": 0.0}

    def start(self) -> np.ndarray:
        """First guess of each pattern's posterior: how much of what the functions say speaks for a match."""
        z = np.array([sum(self.PRO.get(c[i], 0.0) for c in self.columns) for i in range(len(self.n))])
        return 1 / (1 + np.exp(-z))

    def _rules(self, group: tuple[int, ...], f: np.ndarray) -> np.ndarray:
        """What the rules say of each value of a factor, as a probability of a match."""
        odds = np.zeros(f.max() + 1)
        odds[f] = [sum(self.PRO.get(self.columns[i][r], 0.0) for i in group) for r in range(len(f))]
        return 1 / (1 + np.exp(-odds))

    def learn(self, post: np.ndarray) -> np.ndarray:
        rules = [self._rules(g, f) for g, f in zip(self.names, self.factors, strict=True)]
        for _ in range(ROUNDS):
            z = np.full(len(self.n), np.log((self.n @ post + PRIOR / 2) / (self.n @ (1 - post) + PRIOR / 2)))
            for f, r in zip(self.factors, rules, strict=True):
                k = f.max() + 1
                yes = np.bincount(f, weights=self.n * post, minlength=k) + PRIOR * r / k
                no = np.bincount(f, weights=self.n * (1 - post), minlength=k) + PRIOR * (1 - r) / k
                z += (np.log(yes / yes.sum()) - np.log(no / no.sum()))[f]
            self.logit = np.clip(z, -40, 40)
            new = 1 / (1 + np.exp(-self.logit))
            if np.abs(new - post).max() < 1e-6:
                return new
            post = new
        return post

    def correlation(self, f: np.ndarray, g: np.ndarray, post: np.ndarray) -> float:
        """Conditional mutual information of two factors given the hidden variable, as a share of the lesser entropy."""
        total, out, hf, hg = self.n.sum(), 0.0, 0.0, 0.0
        for w in (self.n * post, self.n * (1 - post)):
            if w.sum() <= 0:
                continue
            joint = np.bincount(f * (g.max() + 1) + g, weights=w, minlength=(f.max() + 1) * (g.max() + 1)).reshape(f.max() + 1, -1) / w.sum()
            outer = joint.sum(1, keepdims=True) @ joint.sum(0, keepdims=True)
            ok = joint > 0
            share = w.sum() / total
            out += share * float((joint[ok] * np.log(joint[ok] / outer[ok])).sum())
            for side, p in (("f", joint.sum(1)), ("g", joint.sum(0))):
                h = -share * float((p[p > 0] * np.log(p[p > 0])).sum())
                hf, hg = (hf + h, hg) if side == "f" else (hf, hg + h)
        return out / min(hf, hg) if min(hf, hg) > 1e-6 else 0.0

    def fit(self) -> np.ndarray:
        post = self.start()
        pairs = sorted(
            ((self.correlation(self.factors[i], self.factors[j], post), i, j) for i, j in combinations(range(len(self.factors)), 2)), reverse=True
        )
        home = list(range(len(self.factors)))
        for c, i, j in pairs:
            if c >= CORRELATED and home[i] != home[j]:
                home = [home[i] if h == home[j] else h for h in home]
        self.names = [tuple(k for k, h in enumerate(home) if h == g) for g in sorted(set(home), key=home.index)]
        self.factors = [self._codes(g) for g in self.names]
        return self.learn(self.start())


def confidences(votes: DataFrame) -> DataFrame:
    """votes with the posterior of each pair and its `logit`."""
    counted = votes.groupBy(*FUNCTIONS).count()
    rows = counted.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError("too many distinct vote patterns")
    spark = votes.sparkSession
    if not rows:
        return votes.withColumn("posterior", F.lit(0.0)).withColumn("logit", F.lit(-40.0))
    model = LabelModel([tuple(r[f] for f in FUNCTIONS) for r in rows], np.array([r["count"] for r in rows]))
    post = model.fit()
    table = pd.DataFrame([tuple(r[f] for f in FUNCTIONS) for r in rows], columns=list(FUNCTIONS))
    table["posterior"], table["logit"] = post, model.logit
    return votes.join(F.broadcast(spark.createDataFrame(table)), list(FUNCTIONS))


def described(matches: DataFrame, facilities: DataFrame) -> DataFrame:
    """(match_id, facility_id, confidence): the facility records each row describes.

    A facility registered more than once counts with each of its records. A row whose address does not decide between
    several facilities of its name describes none of them with confidence.
    """
    ship_package(matches.sparkSession)
    sides = [("m", names.records(matches, "match_id", "source_facility_name", "source_address")), ("f", names.records(facilities, "facility_id", "facility", "address", "prefecture"))]
    tagged = [r.withColumn("rec", F.concat(F.lit(t), "rec")) for t, r in sides]  # the two tables' ids may be alike
    recs = cut(names.keyed(tagged[0].unionByName(tagged[1])))
    left_recs, right_recs = (recs.where(F.col("rec").startswith(t)).withColumn("rec", F.expr("substring(rec, 2)")) for t, _ in sides)
    both = cut(names.forms_of(recs, **{f"in_{t}": F.col("rec").startswith(t) for t, _ in sides}))
    left, right = both.where("in_m"), both.where("in_f")
    # a form that stands in both tables is a pair of its own
    own = both.where("in_m and in_f").select(F.col("form").alias("a"), F.col("form").alias("b"), *[F.col(k).alias(f"{s}_{k}") for s in "ab" for k in names.PLACES])
    own = own.select("a", "b", names.relation("a", "b").alias("relation")).where("relation != 'apart'")
    # pairs drawn by hash show the model what no match looks like
    pairs = names.candidates(left, right, contrast=True).unionByName(own)  # candidates() gives pairs of two forms
    members = cut(names.grouped(right_recs, right)).select(F.col("form").alias("b"), "root", F.col("rec").alias("facility_id"))
    judged = confidences(cut(votes_of(names.sided(pairs, both))))
    # of the facilities that a row could mean at most one is meant: their odds share what there is
    odds = joined(judged, members.select("b", "root").distinct(), "b").groupBy("a", "root").agg(F.exp(F.max("logit")).alias("odds"))
    share = F.col("odds") / (1 + F.sum("odds").over(Window.partitionBy("a")))
    sure = odds.withColumn("confidence", share).where(F.col("confidence") >= CONFIDENT)
    rows = joined(sure, left_recs.where("snd != ''").select(F.xxhash64(*names.KEYS).alias("a"), F.col("rec").alias("match_id")), "a")
    return joined(rows, members.select("root", "facility_id").distinct(), "root").select(F.col("match_id").cast("bigint").alias("match_id"), "facility_id", "confidence")
