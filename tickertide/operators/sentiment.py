"""Sentiment over tables: the lexicon tier as an expression, the model tier over distinct texts, and the whole chain."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickertide.config import SentimentConfig, TextConfig
from tickertide.functions import sentiment as S
from tickertide.functions import text as X

#: Terms of a lexicon at most: it is held in every task. Vocabularies stay far below.
MOST_TERMS = 500_000
#: Terms up to which a word is first compared with all of them.
FEW_TERMS = 64
#: Separates terms in a literal; no word holds it.
_SEPARATOR = "\x01"


def terms_of(lexicon: DataFrame) -> list[tuple[str, float]]:
    """The lexicon's terms in order of their bytes; a term that repeats counts once, with its greatest valence."""
    rows = lexicon.groupBy("term").agg(F.max("valence").alias("valence")).where("term is not null and valence is not null").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"a lexicon may have {MOST_TERMS} terms at most")
    return sorted(((r["term"], float(r["valence"])) for r in rows), key=lambda r: r[0].encode())


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


class Lexicon:
    """Valences by a hash table that stands in the plan as two literals, whatever the number of terms.

    A term lies in one of two slots (cuckoo hashing), of the low and the high bits of Spark's xxhash64, so a lookup
    compares a word with two terms at most and builds nothing. There are more than two slots a term.
    """

    def __init__(self, terms: list[tuple[str, float]]):
        self.few = [t for t, _ in terms] if len(terms) <= FEW_TERMS else None
        known = {t: (xxh64_intdigest(t.encode(), 42), v) for t, v in terms if t and _SEPARATOR not in t}
        self.bits = max((2 * len(known)).bit_length(), 2)
        while (dealt := self._dealt(known)) is None:
            self.bits += 1
        literal = lambda values, kind: F.split(F.lit(_SEPARATOR.join(values)), _SEPARATOR, -1).cast(f"array<{kind}>")
        # an empty slot has the empty text, which is no term
        self.names, self.values = literal((t or "" for t in dealt), "string"), literal((repr(known[t][1]) if t else "0.0" for t in dealt), "double")

    def _dealt(self, known: dict[str, tuple[int, float]]) -> list[str | None] | None:
        """The term of each slot, or None if they do not fit."""
        slots: list[str | None] = [None] * (1 << self.bits)
        places = lambda h: (h & (len(slots) - 1), h >> (64 - self.bits))
        for term, (h, _) in known.items():
            at = places(h)[0]
            for _ in range(500):
                slots[at], term = term, slots[at]
                if term is None:
                    break
                one, two = places(known[term][0])
                at = two if at == one else one
            else:
                return None
        return slots

    def valence(self, word: Column) -> Column:
        """Null for words that the lexicon does not have."""
        one = F.xxhash64(word).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")
        two = F.shiftrightunsigned(F.xxhash64(word), 64 - self.bits).cast("int")
        found = F.when(word == "", None).when(F.get(self.names, one) == word, F.get(self.values, one)).when(F.get(self.names, two) == word, F.get(self.values, two))
        # the same, but most words are told apart at once where there are few to compare with
        return F.when(word.isin(*self.few), found) if self.few else found


def words_of(df: DataFrame, column: str) -> Lexicon:
    """A lexicon that tells which words a table of a vocabulary's size has."""
    return Lexicon(terms_of(df.select(F.col(column).alias("term"), F.lit(1.0).alias("valence"))))


def lexicon_scores(text: Column, terms: list[tuple[str, float]], negations: Sequence[str] = (), boosters: Sequence[str] = (), cfg: SentimentConfig = SentimentConfig(), look_back: int = 3) -> Column:
    """compound, pos, neg, neu of a text, as one expression: no shuffle, and it runs on streams."""
    empty = F.struct(F.lit(0.0).alias("compound"), F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"), F.lit(1.0).alias("neu"))
    if not terms:
        return empty
    lexicon = Lexicon(terms)

    def value(ws: Column, hit: Column) -> Column:
        i, v = hit["i"], hit["v"]
        # null before the first word
        before = [F.get(ws, i - k) for k in range(1, look_back + 1)]
        has = lambda some: F.coalesce(reduce(lambda x, y: x | y, (b.isin(*some) for b in before)), F.lit(False)) if some and before else F.lit(False)
        boosted = v + F.when(has(boosters), F.signum(v) * cfg.boost).otherwise(0.0)
        return boosted * F.when(has(negations), cfg.negation).otherwise(1.0)

    def scored(ws: Column) -> Column:
        hits = F.filter(F.transform(ws, lambda w, i: F.struct(i.alias("i"), lexicon.valence(w).alias("v"))), lambda h: h["v"] != 0)
        found = F.filter(F.transform(hits, lambda h: value(ws, h)), lambda v: v != 0)
        add = lambda vs, f: F.aggregate(vs, F.lit(0.0), lambda acc, v: acc + f(v))
        sums = lambda vs: F.struct(add(vs, lambda v: v).alias("s"), add(vs, lambda v: F.when(v > 0, v + 1).otherwise(0.0)).alias("p"), add(vs, lambda v: F.when(v < 0, 1 - v).otherwise(0.0)).alias("n"), (F.size(ws) - F.size(vs)).cast("double").alias("z"))
        total = lambda x: x["p"] + x["n"] + x["z"]
        out = lambda x: F.struct((x["s"] / F.sqrt(x["s"] * x["s"] + cfg.alpha)).alias("compound"), (x["p"] / total(x)).alias("pos"), (x["n"] / total(x)).alias("neg"), (x["z"] / total(x)).alias("neu"))
        return F.when(F.size(ws) > 0, _bind(found, lambda vs: _bind(sums(vs), out))).otherwise(empty)

    return F.coalesce(_bind(X.words(F.lower(text)), scored), empty)


def lexicon_sentiment(df: DataFrame, lexicon: DataFrame, id_col: str = "id", text: Column | str = "text", negations: Sequence[str] = (), boosters: Sequence[str] = (), cfg: SentimentConfig = SentimentConfig()) -> DataFrame:
    """lexicon (term, valence) -> id, compound, pos, neg, neu, a row for each of df's. Empty and null texts: 0, 0, 0, 1."""
    text = F.col(text) if isinstance(text, str) else text
    return df.select(id_col, lexicon_scores(text, terms_of(lexicon), negations, boosters, cfg).alias("fast")).select(id_col, "fast.*")


def score_distinct(df: DataFrame, text_col: str, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """scorer (a frame of distinct texts -> the frame with more columns) runs once a text; results are joined back by hash and text."""
    keyed = df.withColumn("_h", F.xxhash64(text_col))
    scored = scorer(keyed.select("_h", text_col).distinct()).withColumnRenamed(text_col, "_text").withColumnRenamed("_h", "_k")
    return keyed.join(scored, (F.col("_h") == F.col("_k")) & F.col(text_col).eqNullSafe(F.col("_text"))).drop("_h", "_k", "_text")


def deep_scores(df: DataFrame, scorer: Callable[[list[str]], list[tuple[float, float, float]]], text_col: str = "text", cfg: TextConfig = TextConfig()) -> DataFrame:
    """df with p_neg, p_neu, p_pos and deep_failed: the scorer sees each distinct text once, in batches. Where it raises, the
    batch is given again text by text, and texts that it cannot score have no deep tier: nulls, and deep_failed is true, to be counted."""

    def one_by_one(texts: list[str]) -> list[tuple]:
        found = []
        for t in texts:
            try:
                found.append((*scorer([t])[0], False))
            except Exception:  # this text goes without
                found.append((None, None, None, True))
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text_col].fillna("").str.slice(0, cfg.max_deep_chars).tolist()
            try:
                probs = [(*p, False) for p in scorer(texts)]
            except Exception:
                probs = one_by_one(texts)
            yield pdf.assign(**{c: [p[k] for p in probs] for k, c in enumerate(("p_neg", "p_neu", "p_pos", "deep_failed"))})

    return score_distinct(df, text_col, lambda d: d.mapInPandas(run, f"_h long, `{text_col}` string, p_neg double, p_neu double, p_pos double, deep_failed boolean"))


def fit_default_model(labelled: DataFrame, text_col: str = "text", label_col: str = "label", features: int = 1 << 14):
    """A logistic regression over hashed words, fitted by Spark on all labelled rows; transform() adds probability and prediction."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    stages = [RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=X.NON_WORD), HashingTF(inputCol="_words", outputCol="_features", numFeatures=features), LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=10, regParam=0.01)]
    return Pipeline(stages=stages).fit(labelled)


def score_posts(posts: DataFrame, lexicon: DataFrame | list[tuple[str, float]], deep: DataFrame | None = None, cfg: SentimentConfig = SentimentConfig(), text_cfg: TextConfig = TextConfig(), negations: Sequence[str] = (), boosters: Sequence[str] = ()) -> DataFrame:
    """The chain from raw posts to label, score, confidence, impact and ticker sentiments. deep: id, p_neg, p_neu, p_pos.

    lexicon: a table, or the sorted terms of terms_of(); with these and without deep scores it is one narrow stage and runs on a stream.
    """
    rows = posts.withColumn("pre", X.preprocess(F.col("title"), F.col("selftext"), F.col("subreddit"), F.col("score"), F.col("upvote_ratio"), F.col("num_comments"), text_cfg))
    terms = terms_of(lexicon) if isinstance(lexicon, DataFrame) else lexicon
    rows = rows.withColumn("fast", lexicon_scores(F.col("pre.cleaned_text"), terms, negations, boosters, cfg)).select("*", "fast.*").drop("fast")
    if deep is None:
        rows = rows.withColumn("deep_score", F.lit(None).cast("double"))
    else:
        rows = rows.join(deep.select("id", S.label5_from_probs(F.col("p_neg"), F.col("p_neu"), F.col("p_pos"))["score"].alias("deep_score"), F.col("p_neg").isNull().alias("_none")), "id", "left").withColumn("deep_score", F.when(~F.col("_none"), F.col("deep_score"))).drop("_none")
    rows = rows.withColumn("final", S.ensemble_score(F.col("compound"), F.col("deep_score"), F.col("pre.score"), F.col("pre.upvote_ratio"), cfg))
    rows = rows.withColumn("sentiment_label", S.label5(F.col("final"))).withColumn("confidence", S.confidence(F.col("final")))
    return rows.withColumn("market_impact", S.market_impact(F.col("final"), F.col("confidence"))).withColumn("ticker_sentiments", S.ticker_sentiments(F.col("pre.tickers"), F.col("sentiment_label"), F.col("final"), F.col("confidence"))).withColumnRenamed("final", "sentiment_score")


def ticker_rows(scored: DataFrame) -> DataFrame:
    """One row for each post and ticker; posts without tickers have none."""
    return scored.select("id", F.inline("ticker_sentiments"))
