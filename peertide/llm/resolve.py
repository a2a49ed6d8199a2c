"""Matching release hashes to catalogue entries without a common key.

Similarity vectors of candidate pairs are separated by a regularised two-component Gaussian mixture fitted without labels;
transitivity is enforced inside expectation-maximisation; the result is a posterior per pair.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peertide.functions.release import with_parsed
from peertide.operators.skew import salted_join
from peertide.session import durable, spread

def imdb_number(c: Column) -> Column:
    """Seven or more digits of the identifier; junk words, 0 and blanks are null."""
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"(?:^|tt)\s*0*([1-9]\d{5,})\s*$", 1), F.lit(""))


def _edits1(name: str) -> Column:
    """The word itself and what remains after dropping each one of its letters: words one edit apart share one of these."""
    c = F.col(name)
    cut = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substr(c, i + 1)))
    return F.explode(F.array_distinct(F.array_append(cut, c)))


def near_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, to, n): the vocabulary words (word, n) that each word equals, or comes within one edit or one exchange of
    neighbours of, if it has five letters or more. Words meet by what is left when one letter is dropped."""

    def letters(c: str) -> Column:
        return F.array_sort(F.split(c, ""))

    gap = F.levenshtein("word", "to", 2)
    known = vocabulary.select(F.col("word").alias("to"), "n")
    equal = words.join(known, F.col("word") == F.col("to")).select("word", "to", "n")
    long = words.where(F.length("word") >= 5).select("word", _edits1("word").alias("part"))
    close = long.join(known.where(F.length("to") >= 4).select("to", "n", _edits1("to").alias("part")), "part").where("word != to").select("word", "to", "n").distinct()
    close = close.where((gap == 1) | ((gap == 2) & (letters("word") == letters("to"))))
    return equal.unionByName(close)


def candidates(names: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, c_name): every pair of a name and a catalogue name of which the shorter one in different words (the
    catalogue's, if they are equal) finds all of them in the other; words count as found when they are equal or near (see near_words). Nothing is left out for being
    frequent. Names of like length that lack a word of each other are left out: they are too far apart to be one work.

    Both arguments have one column `name`, distinct. The pairs are found without comparing all: the shorter name is posted under
    its two rarest words together (or its only one) and looked up under the pairs of the other's words, once with the
    catalogue and once with the name as the shorter. What meets is settled by counting words. Keys of many names are split.
    """
    c_words = catalog.select(F.col("name").alias("c_name"), F.array_distinct(F.split("name", " ")).alias("c"))
    vocabulary = c_words.select(F.explode("c").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = names.select("name", F.posexplode(F.array_distinct(F.split("name", " "))).alias("at", "word"))
    near = durable(near_words(words.select("word").distinct(), vocabulary))
    by_word = near.groupBy("word").agg(F.min("n").alias("n"), F.collect_list("to").alias("to"))
    left = words.join(by_word, "word", "left").groupBy("name").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", F.coalesce("to", F.array()).alias("to")))).alias("a"))
    left = durable(left)  # (name, its words' counterparts, rarest first)
    freq = c_words.select("c_name", F.explode("c").alias("word")).join(vocabulary, "word")
    right = durable(freq.groupBy("c_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]).alias("c")))

    # one word: itself; more: pairs of different places
    two_left = "flatten(transform({a}, (x, i) -> flatten(transform(slice({a}, i + 2, size({a})), y -> flatten(transform(x.to, p -> transform(y.to, q -> concat(least(p, q), ' ', greatest(p, q)))))))))"
    two_right = "flatten(transform({a}, (x, i) -> transform(slice({a}, i + 2, size({a})), y -> concat(least(x, y), ' ', greatest(x, y)))))"
    one_left, one_right = "flatten(transform({a}, x -> x.to))", "{a}"

    def posted(df: DataFrame, id_: str, words_: str, one: str, two: str) -> DataFrame:
        short = f"case when size({words_}) = 1 then {one.format(a=words_)} else {two.format(a=f'slice({words_}, 1, 2)')} end"
        return df.select(id_, F.explode(F.array_distinct(F.transform(F.expr(short), lambda x: F.xxhash64(x)))).alias("key"))

    def looked_up(df: DataFrame, id_: str, words_: str, one: str, two: str) -> DataFrame:
        keys = F.expr(f"concat({one.format(a=words_)}, {two.format(a=words_)})")
        return df.select(id_, F.explode(F.array_distinct(F.transform(keys, lambda x: F.xxhash64(x)))).alias("key"))

    # keys travel as numbers, words only with the pairs that met
    l, r = (left, "name", "a", one_left, two_left), (right, "c_name", "c", one_right, two_right)
    met = salted_join(durable(looked_up(*l)), posted(*r), ["key"]).select("name", "c_name")
    met = met.unionByName(salted_join(durable(looked_up(*r)), posted(*l), ["key"]).select("name", "c_name")).distinct()
    both = met.join(left, "name").join(right, "c_name")
    of_right = F.expr("forall(c, y -> exists(a, x -> array_contains(x.to, y)))")
    of_left = F.expr("forall(a, x -> arrays_overlap(x.to, c))")
    return both.where(F.when(F.expr("size(c) <= size(a)"), of_right).otherwise(of_left)).select("name", "c_name")


#: Order of the similarity vector: similarity (0..10) of the release's name, or of its title where that says nothing,
#: and of the title beside a release name; year (0 differs, 3 one off, 4 same),
#: number, kind and imdb (0 differs, 1 same); -1 where an attribute is missing.
FEATURES = ("f_name", "f_title", "f_year", "f_no", "f_kind", "f_imdb")
_SCALE = np.array([10.0, 10.0, 4.0, 1.0, 1.0, 1.0])
_LEVELS = (12, 12, 6, 3, 3, 3)  # of each feature, -1 included
_GROUPS = ((0, 1), (2,), (3,), (4,), (5,))  # only the names co-vary; all else is independent


@dataclass(frozen=True)
class Prior:
    """Normal-inverse-Wishart prior of both components, the same for every attribute: what regularises the mixture.

    weight: pairs imagined beside the seen ones, as a share of them. They have full agreement as their mean in the matched component and the
    mean of all pairs in the unmatched one, and the deviation `spread` (of a scale from 0 to 1) in both: at 0.5, the largest a
    value between 0 and 1 can have, they say nothing about it.
    """

    weight: float = 0.1
    spread: float = 0.5


def similarity(a: Column, b: Column) -> Column:
    """Similarity in tenths, best of both word orders: the smaller of the share of letters kept and of 1 less 0.15 for each
    edit, since a long shared word makes two works no more alike; -1 if one name is missing."""

    def ordered(x: Column) -> Column:
        return F.array_join(F.array_sort(F.split(x, " ")), " ")

    def letters(x: Column) -> Column:
        return F.array_sort(F.split(x, ""))

    lev = F.least(F.levenshtein(a, b), F.levenshtein(ordered(a), ordered(b)))
    swapped = (lev == 2) & (letters(a) == letters(b))  # two letters exchanged are one slip
    edits = F.when(a == b, F.lit(0)).when(swapped, F.lit(1)).otherwise(lev)
    kept = 1 - edits / F.greatest(F.length(a), F.length(b), F.lit(1))
    s = F.greatest(F.least(kept, 1 - edits * 0.15), F.lit(0.0))
    return F.when(a.isNull() | b.isNull(), F.lit(-1)).otherwise(F.round(s * 10).cast("int"))


class Mixture:
    """Two Gaussians over similarity vectors with missing parts, weighted rows, block-diagonal covariances, fitted to the largest
    posterior under a Prior. Each step of `fit_step` after `posterior` is a step of expectation-maximisation (missing parts are
    filled in by their expectation), so `objective` never falls while responsibilities are left as they come."""

    def __init__(self, x: np.ndarray, n: np.ndarray, prior: Prior = Prior()):
        self.x = np.where(x < 0, np.nan, x / _SCALE)
        self.n = n.astype(float)
        self.prior = prior
        self.seen = ~np.isnan(self.x)
        every = np.array([np.average(self.x[s, j], weights=self.n[s]) if (s := self.seen[:, j]).any() else 0.5 for j in range(len(FEATURES))])
        self.centre = np.ones(len(FEATURES)), every
        names = np.nanmax(np.where(self.seen[:, :2], self.x[:, :2], 0), axis=1)
        rest = np.where(self.seen[:, 2:], self.x[:, 2:], 0.5).min(axis=1)
        self.g = np.where((names >= 0.9) & (rest >= 0.5), 0.95, 0.05)  # a start, not a label
        self.pi = 0.5
        self.params = [(c, np.eye(len(FEATURES)) * prior.spread**2) for c in self.centre]

    def fit_step(self, g: np.ndarray) -> None:
        """The largest posterior of the parameters given responsibilities, from the parameters before."""
        total = self.n.sum()
        imagined = self.prior.weight * total
        self.pi = float(((self.n * g).sum() + imagined) / (total + 2 * imagined))
        new = []
        for k, w in enumerate((self.n * g, self.n * (1 - g))):
            mean, cov = self.params[k][0].copy(), np.zeros((len(FEATURES),) * 2)
            for block in map(list, _GROUPS):
                mu, sigma = self.params[k][0][block], self.params[k][1][np.ix_(block, block)]
                any_ = self.seen[:, block].any(axis=1)
                full = np.where(self.seen[:, block], self.x[:, block], mu)
                extra = np.zeros((len(block),) * 2)
                if len(block) == 2:
                    for a, b in ((0, 1), (1, 0)):  # seen, missing
                        only = self.seen[:, block[a]] & ~self.seen[:, block[b]]
                        slope = sigma[a, b] / sigma[a, a]
                        full[only, b] = mu[b] + slope * (full[only, a] - mu[a])
                        extra[b, b] += w[only].sum() * (sigma[b, b] - slope * sigma[a, b])
                w_, f = w[any_], full[any_]
                size = w_.sum()
                m0 = self.centre[k][block]
                m = ((w_[:, None] * f).sum(axis=0) + imagined * m0) / (size + imagined)
                d, d0 = f - m, m0 - m
                scatter = (w_[:, None] * d).T @ d + extra + imagined * np.outer(d0, d0) + imagined * self.prior.spread**2 * np.eye(len(block))
                mean[block] = m
                cov[np.ix_(block, block)] = scatter / (size + imagined)
            new.append((mean, cov))
        self.params = new

    def _logs(self) -> np.ndarray:
        out = np.log([[self.pi], [1 - self.pi]]) * np.ones(len(self.x))
        for k, (mean, cov) in enumerate(self.params):
            for block in map(list, _GROUPS):
                for pattern in itertools.product((False, True), repeat=len(block)):
                    rows = np.flatnonzero((self.seen[:, block] == pattern).all(axis=1))
                    dims = [b for b, p in zip(block, pattern, strict=True) if p]
                    if len(rows) and dims:
                        c = cov[np.ix_(dims, dims)]
                        d = self.x[np.ix_(rows, dims)] - mean[dims]
                        out[k, rows] -= 0.5 * (np.linalg.slogdet(2 * np.pi * c)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))
        return out

    def posterior(self) -> np.ndarray:
        out = self._logs()
        return 1 / (1 + np.exp(np.clip(out[1] - out[0], -50, 50)))

    def objective(self) -> float:
        """Log likelihood of the pairs and of the imagined ones: what the steps raise."""
        imagined = self.prior.weight * self.n.sum()
        value = float((self.n * np.logaddexp(*self._logs())).sum()) + imagined * (np.log(self.pi) + np.log(1 - self.pi))
        for k, (mean, cov) in enumerate(self.params):
            for block in map(list, _GROUPS):
                c, d0 = cov[np.ix_(block, block)], self.centre[k][block] - mean[block]
                inv = np.linalg.inv(c)
                value -= 0.5 * imagined * (np.linalg.slogdet(c)[1] + d0 @ inv @ d0 + self.prior.spread**2 * np.trace(inv))
        return value

    def fit(self, steps: int = 200, least: float = 1e-7) -> None:
        """Steps until the objective rises by less than the share `least`, from the responsibilities at hand."""
        self.fit_step(self.g)
        before = -np.inf
        for _ in range(steps):
            self.g = self.posterior()
            self.fit_step(self.g)
            now = self.objective()
            if now - before <= least * abs(now):
                break
            before = now
        self.g = self.posterior()


#: Posterior under which a pair is left out of the search for contradictions: it stands for nothing either way.
LIVE = 0.01


def match(
    hashes: DataFrame, catalog: DataFrame, *, rounds: int = 3, settled: float = 1e-3, threshold: float = 0.5, prior: Prior = Prior()
) -> DataFrame:
    """(hash, catalog_ip_id, confidence) for pairs with a posterior of at least `threshold`.

    hashes: hash, raw_name, title, imdb_id, category. catalog: ip_id (its prefix is the kind), ip (the title), imdb_id,
    release_date.

    Rows of hashes with the same parsed attributes are one mention, so a title that holds a third of all rows is compared
    once; where mentions meet their candidates and hashes their mentions, hot keys are split. Candidates: see `candidates`. Their
    similarity vectors lie on a grid of at most 12 x 12 x 6 x 3 x 3 x 3 points; the mixture is fitted on the counts per point,
    which are all that reaches the driver.

    Transitivity: two catalogue entries can both stand for a mention only if they match each other. In each round the
    posterior of a candidate is held below that of the match between it and the mention's best candidate, the matches within
    the catalogue are held to the same rule among themselves, and the mixture is fitted again to the posteriors so held, until
    no grid point's moves by more than `settled` or after `rounds`. Only pairs of a posterior over LIVE can contradict each other, so
    only they are moved for it.

    Null and noisy attributes are missing, not different; a hash without any name gets no match; repeated rows count once; ties
    between different works share the posterior and stay under the threshold; empty tables give no rows.
    """
    kinds = {"Movies": "film", "Series": "series", "Anime": "anime"}
    kind = F.coalesce(*[F.when(F.col("category") == k, v) for k, v in kinds.items()])
    h = hashes.select("hash", "raw_name", "title", imdb_number(F.col("imdb_id")).alias("imdb"), kind.alias("c_kind")).where("hash is not null")
    attrs = ["r_name", "t_name", "r_no", "t_no", "year", "kind", "imdb"]
    h = with_parsed(spread(h)).withColumn("kind", F.coalesce("c_kind", "r_kind")).select("hash", *attrs).distinct()
    h = durable(h.withColumn("m", F.xxhash64(*[F.coalesce(F.col(a).cast("string"), F.lit("\x00")) for a in attrs])))
    mention = h.select("m", *attrs).where("coalesce(r_name, t_name) is not null").distinct()

    c = catalog.select(
        F.col("ip_id").alias("cid"),
        F.lit(None).cast("string").alias("raw_name"),
        F.col("ip").alias("title"),
        F.split("ip_id", "-")[0].alias("kind"),
        imdb_number(F.col("imdb_id")).alias("imdb"),
        F.try_to_number(F.substring("release_date", 1, 4), F.lit("9999")).cast("int").alias("c_year"),
    ).where("ip_id is not null")
    c = with_parsed(c).select("cid", F.col("t_name").alias("name"), F.col("t_no").alias("no"), F.col("c_year").alias("year"), "kind", "imdb").where("name is not null").distinct()
    c = durable(c)

    names = mention.select(F.explode(F.array_distinct(F.array("r_name", "t_name"))).alias("name")).where("name is not null")
    names = names.union(c.select("name")).distinct()
    by_name = durable(candidates(names, c.select("name").distinct()))
    right = by_name.join(c.select("cid", F.col("name").alias("c_name"), F.col("no").alias("c_no"), F.col("year").alias("c_year"), F.col("kind").alias("c_kind"), F.col("imdb").alias("c_imdb")), "c_name")

    def same(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | b.isNull(), F.lit(-1)).otherwise((a == b).cast("int"))

    def vectors(left: DataFrame) -> DataFrame:
        """(m, cid, point): candidate pairs with the number of their grid point."""
        gap = F.abs(F.col("year") - F.col("c_year"))
        f_year = F.when(gap.isNull(), F.lit(-1)).when(gap == 0, F.lit(4)).when(gap == 1, F.lit(3)).otherwise(F.lit(0))
        cand = left.select("m", *attrs, F.explode(F.array_distinct(F.array("r_name", "t_name"))).alias("name")).where("name is not null")
        cand = salted_join(cand, right, ["name"]).drop("name")
        cand = cand.dropDuplicates(["m", "cid"])
        same_name = F.col("r_name") == F.col("t_name")
        # first the similarities on their own: each is used several times below
        cand = cand.withColumn("f_raw", similarity(F.col("r_name"), F.col("c_name")))
        cand = cand.withColumn("f_own", F.when(same_name, F.col("f_raw")).otherwise(similarity(F.col("t_name"), F.col("c_name"))))
        number = F.when(F.col("f_raw") >= F.col("f_own"), F.col("r_no")).otherwise(F.col("t_no"))
        no_raw = F.col("r_name").isNull()
        f = [
            F.when(no_raw, F.col("f_own")).otherwise(F.col("f_raw")), F.when(no_raw, F.lit(-1)).otherwise(F.col("f_own")), f_year,
            same(F.coalesce(number, F.col("r_no"), F.col("t_no")), F.col("c_no")), same(F.col("kind"), F.col("c_kind")), same(F.col("imdb"), F.col("c_imdb")),
        ]
        point = F.lit(0)
        for value, levels in zip(f, _LEVELS, strict=True):
            point = point * levels + value + 1
        return cand.select("m", "cid", point.cast("int").alias("point"))

    pairs = durable(vectors(mention))
    none = [F.lit(None).cast(t).alias(a) for a, t in (("t_name", "string"), ("t_no", "int"))]
    twin = c.select(F.xxhash64("cid").alias("m"), F.col("name").alias("r_name"), F.col("no").alias("r_no"), "year", "kind", "imdb", *none)
    twins = durable(vectors(twin).where(F.col("m") != F.xxhash64("cid")))

    grid = pairs.groupBy("point").agg(F.count(F.lit(1)).alias("n")).collect()
    schema = "hash string, catalog_ip_id string, confidence double"
    if not grid:
        return hashes.sparkSession.createDataFrame([], schema)
    point = np.array([r.point for r in grid])
    model = Mixture(vectors_of(point), np.array([r.n for r in grid]), prior)
    model.fit()
    twin_point = np.array([r.point for r in twins.select("point").distinct().collect()], int)

    def live(df: DataFrame, points: np.ndarray) -> DataFrame:
        """Pairs of a posterior over LIVE, with it; at most the size of the grid is broadcast."""
        probe = Mixture(vectors_of(points), np.ones(len(points)), prior)
        probe.pi, probe.params = model.pi, model.params
        rows = [(int(a), float(b)) for a, b in zip(points, probe.posterior() if len(points) else [], strict=True) if b >= LIVE]
        return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, "point int, p double")), "point")

    def held(df: DataFrame, points: np.ndarray, q: DataFrame) -> DataFrame:
        """Live pairs with their posterior held to transitivity with their best candidate: (m, cid, point, p, g)."""
        best = Window.partitionBy("m").orderBy(F.desc("p"), "cid")
        p = live(df, points).withColumn("top", F.first("cid").over(best)).withColumn("of", F.first("p").over(best))
        other = p.where("cid != top").join(q.select(F.col("m").alias("_m"), F.col("cid").alias("_cid"), F.col("g").alias("q")), (F.xxhash64("top") == F.col("_m")) & (F.col("cid") == F.col("_cid")), "left")
        other = other.withColumn("q", F.coalesce("q", F.lit(0.0))).drop("_m", "_cid")
        # an equal rival that is another work halves both
        rival = F.when((F.col("q") < 0.5) & (F.col("p") >= F.col("of") - 1e-9), F.col("p"))
        against = other.groupBy("m").agg(F.max(rival).alias("rival")).where("rival is not null")
        first = p.where("cid = top").join(against, "m", "left").withColumn("g", F.col("p") * F.col("p") / (F.col("p") + F.coalesce("rival", F.lit(0.0))))
        halved = F.when((F.col("q") < 0.5) & (F.col("p") >= F.col("of") - 1e-9), F.col("p") / 2).otherwise(F.col("p"))
        return first.select("m", "cid", "point", "p", "g").unionByName(other.select("m", "cid", "point", "p", F.least(halved, "q").alias("g")))

    def consistent() -> DataFrame:
        """The pairs held to the catalogue's own matches, and these to each other."""
        among = live(twins, twin_point).select("m", "cid", F.col("p").alias("g"))
        return held(pairs, point, held(twins, twin_point, among))

    where = {int(a): i for i, a in enumerate(point)}
    for _ in range(rounds):
        g, before = model.posterior(), model.posterior()
        for r in consistent().groupBy("point").agg(F.sum(F.col("p") - F.col("g")).alias("less")).collect():
            g[where[r.point]] -= r.less / model.n[where[r.point]]
        model.fit_step(np.clip(g, 0, 1))
        model.g = model.posterior()
        if np.abs(model.g - before).max() <= settled:
            break
    good = consistent().where(F.col("g") >= threshold).select("m", F.col("cid").alias("catalog_ip_id"), F.col("g").alias("confidence"))
    return salted_join(h.select("hash", "m"), good, ["m"]).groupBy("hash", "catalog_ip_id").agg(F.max("confidence").alias("confidence"))


def vectors_of(points: np.ndarray) -> np.ndarray:
    """Similarity vectors of numbered grid points."""
    out = np.empty((len(points), len(_LEVELS)))
    rest = points.astype(int)
    for j in range(len(_LEVELS) - 1, -1, -1):
        rest, out[:, j] = np.divmod(rest, _LEVELS[j])
    return out - 1
