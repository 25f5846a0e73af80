"""TF-IDF and hashed encodings of free text as sparse vectors."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tallycast.config import EncoderSpec
from tallycast.functions.hashing import bucket_and_sign
from tallycast.functions.stop_words import ENGLISH
from tallycast.functions.text import ngram_range, run_lengths, run_starts, tokens
from tallycast.operators.guards import require
from tallycast.operators.layout import spread_few_tasks
from tallycast.operators.lookup import BROADCAST_BYTES, table_bytes
from tallycast.session import materialise


# Terms a summary tracks, at first and at most.
TRACKED, MOST_TRACKED = 100_000, 1_000_000
# Twice the error of a summary of T terms that tracks t is at most this times T / t.
SUMMARY_ERROR = 7.0
# Candidates that are counted at first, for each term of the vocabulary.
CANDIDATES = 4
# Candidates that are counted inside the rows; more are joined.
MOST_IN_ROW = 20_000
# Words that the terms of a vocabulary can be made of, where terms are found by their words.
MOST_WORDS = 5_000


def english_stop_words() -> tuple[str, ...]:
    return ENGLISH


def _stop_words(spec: EncoderSpec) -> tuple[str, ...]:
    return english_stop_words() if spec.stop_words is None else spec.stop_words


def with_tokens(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec(), out: str = "tokens") -> DataFrame:
    """Add the tokens of the whole text, in order and without stop words; an array is taken for the tokens of its text."""
    require(df, [text])
    if isinstance(df.schema[text].dataType, ArrayType):
        return df.withColumn(out, F.col(text))
    return spread_few_tasks(df).withColumn(out, tokens(F.col(text), _stop_words(spec)))


def with_terms(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec(), out: str = "terms") -> DataFrame:
    """Add the unigrams and bigrams of the whole text as an array."""
    return (
        with_tokens(df, text, spec, "_tokens")
        .withColumn(out, ngram_range(F.col("_tokens"), *spec.tfidf_ngrams))
        .drop("_tokens")
    )


def tokenised(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """``df`` with the tokens of its texts in their place, written once; what reads them again finds no text to cut."""
    if isinstance(df.schema[text].dataType, ArrayType):
        return df
    return materialise(with_tokens(df, text, spec, text))


def _counted(df: DataFrame, terms: str) -> DataFrame:
    """One row per distinct entry of the array ``terms``, with its count ``tf``.

    Counting is by run lengths of the sorted array, inside the row. The outer
    form of ``inline`` keeps Spark from testing for empty arrays ahead of it,
    which would repeat all the expressions that lead up to the counts.
    """
    keep = [c for c in df.columns if c != terms]
    return (
        df.withColumn("_ordered", F.sort_array(terms))
        .withColumn("_starts", run_starts(F.col("_ordered")))
        .withColumn("_counts", run_lengths(F.col("_ordered"), F.col("_starts")))
        .select(*keep, F.inline_outer("_counts"))
        .filter(F.col("term").isNotNull())
    )


def _tallied(df: DataFrame, terms: str) -> DataFrame:
    """The entries of the array ``terms``, then its different ones: rows with ``_again`` and with ``_once``.

    Their numbers, by term, are the frequencies in the corpus and in documents;
    no array is sorted and no document has to be told from another.
    """
    keep = [c for c in df.columns if c != terms]
    each = F.posexplode_outer(F.concat(terms, F.array_distinct(terms))).alias("_at", "term")
    rows = df.withColumn("_size", F.size(terms)).select(*keep, "_size", each).filter(F.col("term").isNotNull())
    again = F.col("_at") < F.col("_size")
    return rows.select(*keep, "term", F.when(again, 1).alias("_again"), F.when(~again, 1).alias("_once"))


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "term").agg(F.count("_again").alias("tf"), F.count("_once").alias("df"))


def term_counts(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """One row per document and distinct term, with its frequency ``tf``.

    Terms are counted inside the row that holds the text: this moves no data.
    """
    return _counted(with_terms(df, text, spec, "_terms").drop(text), "_terms")


def term_stats(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """Corpus frequency ``tf`` and document frequency ``df`` of every term.

    The only shuffle is by term, of partial sums.
    """
    return _summed(_tallied(with_terms(df.select(text), text, spec, "_terms").drop(text), "_terms"))


@dataclass(frozen=True)
class TermStates:
    """Mergeable summaries of the frequent terms, one row for each ``first_train_fold``.

    A summary counts every term within a known error, from bounded memory; the
    summaries of folds, periods or files add up. ``docs`` and ``terms`` are exact.
    """

    table: DataFrame
    tracked: int

    def merged(self, n_folds: int) -> DataFrame:
        """``fold``, its summary, ``docs`` and ``terms``: of all rows whose first fold is at most that."""
        later = F.explode(F.sequence(F.col("first_train_fold"), F.lit(n_folds - 1)))
        return self.table.withColumn("fold", later).groupBy("fold").agg(
            F.expr(f"approx_top_k_combine(summary, {self.tracked})").alias("summary"),
            F.sum("docs").alias("docs"), F.sum("terms").alias("terms"),
        )


def term_states(df: DataFrame, text: str, spec: EncoderSpec, tracked: int) -> TermStates:
    """Summaries of all terms of ``df``, which carries ``first_train_fold``; no term is shuffled."""
    rows = with_terms(df.select("first_train_fold", text), text, spec, "_terms").drop(text)
    each = rows.select("first_train_fold", F.posexplode_outer("_terms").alias("_at", "_term"))
    state = each.groupBy("first_train_fold").agg(
        F.expr(f"approx_top_k_accumulate(_term, {tracked}) FILTER (WHERE _term IS NOT NULL)").alias("summary"),
        F.count(F.when(F.coalesce("_at", F.lit(0)) == 0, 1)).alias("docs"), F.count("_term").alias("terms"),
    )
    return TermStates(materialise(state), tracked)


def _vector_counts(rows: DataFrame, terms: str, listed: list[str]) -> DataFrame:
    """``first_train_fold``, ``term``, ``tf`` and ``df`` of the listed terms that occur.

    A row's counts are a sparse vector, and vectors are added up where they
    arise: no occurrence becomes a row of its own. Sums of whole numbers are exact.
    """
    vectors = CountVectorizerModel.from_vocabulary(listed, inputCol=terms, outputCol="_tf").transform(rows)
    # The norm of counts is their sum.
    found = vectors.groupBy("first_train_fold").agg(Summarizer.metrics("normL1", "numNonZeros").summary(F.col("_tf")).alias("_s"))
    tf, df = vector_to_array("_s.normL1"), vector_to_array("_s.numNonZeros")
    each = F.arrays_zip(F.lit(listed).alias("term"), tf.cast("array<bigint>").alias("tf"), df.cast("array<bigint>").alias("df"))
    return found.select("first_train_fold", F.inline(each)).filter(F.col("df") > 0)


def _exact_counts(df: DataFrame, text: str, spec: EncoderSpec, wanted: DataFrame | None, n_folds: int) -> DataFrame:
    """``fold``, ``term``, ``tf``, ``df`` of the wanted terms (all, if None), summed over the folds up to each."""
    rows = with_terms(df.select("first_train_fold", text), text, spec, "_terms").drop(text)
    listed = [] if wanted is None else [r["term"] for r in wanted.limit(MOST_IN_ROW + 1).collect()]
    if 0 < len(listed) <= MOST_IN_ROW:
        first = _vector_counts(rows, "_terms", listed)
    else:
        counts = _tallied(rows, "_terms")
        if wanted is not None:
            small = table_bytes(wanted) <= BROADCAST_BYTES
            counts = counts.join(F.broadcast(wanted) if small else wanted, "term", "left_semi")
        first = _summed(counts, "first_train_fold")
    return materialise(_over_folds(first, n_folds))


def _over_folds(first: DataFrame, n_folds: int) -> DataFrame:
    later = F.explode(F.sequence(F.col("first_train_fold"), F.lit(n_folds - 1)))
    return first.withColumn("fold", later).groupBy("fold", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _stats_by_words(df: DataFrame, text: str, spec: EncoderSpec, n_folds: int) -> tuple[DataFrame, dict[int, int]] | None:
    """What ``frequent_stats`` gives, from exact counts of the words; None, if too many words are left.

    No term occurs more often than any of its words. The last of the most
    frequent words that would fill a vocabulary, or else the document bound,
    says how often a term has to occur; only terms made of such words are counted.
    """
    first = df.groupBy("first_train_fold").count().collect()
    docs = {k: sum(r["count"] for r in first if r["first_train_fold"] <= k) for k in range(n_folds)}
    docs = {k: n for k, n in docs.items() if n}
    if not docs:
        return None
    words = _exact_counts(df, text, replace(spec, tfidf_ngrams=(1, 1)), None, n_folds)
    sized = df.sparkSession.createDataFrame(list(docs.items()), "fold int, docs long")
    at_least, at_most = _df_bounds(F.col("docs"), spec)
    kept = words.join(F.broadcast(sized), "fold").filter((F.col("df") >= at_least) & (F.col("df") <= at_most))
    place = F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("tf")))
    top = kept.withColumn("_place", place).filter(F.col("_place") <= spec.tfidf_terms)
    last = top.groupBy("fold").agg(F.count(F.lit(1)).alias("_n"), F.min("tf").alias("_last"))
    least = F.when(F.col("_n") == spec.tfidf_terms, F.col("_last")).otherwise(at_least).alias("_least")
    bound = F.broadcast(materialise(sized.join(last, "fold", "left").select("fold", least)))
    frequent = words.join(bound, "fold").filter(F.col("tf") >= F.col("_least")).select("term").distinct()
    listed = [r["term"] for r in frequent.limit(MOST_WORDS + 1).collect()]
    if len(listed) > MOST_WORDS:
        return None
    # Other words become null, and so do the terms that hold one.
    known = F.transform(text, lambda w: F.when(w.isin(listed), w))
    made = df.select("first_train_fold", known.alias("_known"))
    made = made.select("first_train_fold", F.array_compact(ngram_range(F.col("_known"), *spec.tfidf_ngrams)).alias("_terms"))
    counts = _over_folds(_summed(_tallied(made, "_terms"), "first_train_fold"), n_folds)
    return materialise(counts.join(bound, "fold").filter(F.col("tf") >= F.col("_least")).drop("_least")), docs


def _proven(exact: DataFrame, missing: DataFrame, spec: EncoderSpec) -> bool:
    """Whether no term that was not counted can enter the vocabulary of any fold.

    ``missing`` has each fold's ``docs`` and the most that an uncounted term can
    occur. That has to be less than the last chosen term does, or than the
    document bound, where the vocabulary isn't full.
    """
    at_least, at_most = _df_bounds(F.col("docs"), spec)
    kept = exact.join(missing, "fold").filter((F.col("df") >= at_least) & (F.col("df") <= at_most))
    place = F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("tf")))
    last = kept.withColumn("_place", place).filter(F.col("_place") == spec.tfidf_terms).select("fold", F.col("tf").alias("_last"))
    safe = (F.col("most") < F.coalesce("_last", F.lit(0))) | (F.col("most") < at_least)
    return missing.join(last, "fold", "left").filter(~safe).isEmpty()


def frequent_stats(
    df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec(), n_folds: int = 1, tracked: int = TRACKED
) -> tuple[DataFrame, dict[int, int]]:
    """``term_stats`` by ``fold`` of all terms that can enter a vocabulary, and few others; rows by fold.

    The texts are cut into tokens once. Where single words fill the vocabulary,
    or few are left, terms are found by their words. Else one pass over the tokens
    summarises the frequent terms of all folds, a second counts the candidates exactly. Errors of the summary are bounded, so the
    counts show whether an uncounted term might belong in; if so, more are
    counted, from a larger summary where needed, in the end all. ``df`` may carry
    ``first_train_fold``: a row counts for that fold and all later ones, and
    null for none. The work on texts does not depend on the number of folds.
    """
    if "first_train_fold" not in df.columns:
        df = df.withColumn("first_train_fold", F.lit(0))
    df = tokenised(df.filter(F.col("first_train_fold").isNotNull()).select("first_train_fold", text), text, spec)
    if spec.tfidf_ngrams[0] == 1 and (found := _stats_by_words(df, text, spec, n_folds)):
        return found
    candidates = CANDIDATES * spec.tfidf_terms
    while True:
        states = term_states(df, text, spec, tracked)
        merged = materialise(states.merged(n_folds))
        docs = {r["fold"]: r["docs"] for r in merged.select("fold", "docs").collect()}
        each = F.inline(F.expr(f"approx_top_k_estimate(summary, {tracked})")).alias("term", "most")
        place = F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("most"), "term"))
        listed = materialise(merged.select("fold", each).withColumn("place", place))
        # What is not listed at all occurs no more often than twice the error of the summary.
        error = F.when(F.col("terms") > tracked, F.ceil(SUMMARY_ERROR * F.col("terms") / tracked)).otherwise(0)
        while True:
            beyond = listed.filter(F.col("place") == candidates + 1).select("fold", F.col("most").alias("_next"))
            missing = merged.join(beyond, "fold", "left").select("fold", "docs", F.coalesce("_next", error).alias("most"))
            wanted = materialise(listed.filter(F.col("place") <= candidates).select("term").distinct())
            exact = _exact_counts(df, text, spec, wanted, n_folds)
            if _proven(exact, missing, spec):
                return exact, docs
            if listed.filter(F.col("place") > candidates).isEmpty():
                break
            candidates *= 8
        if tracked >= MOST_TRACKED:
            return _exact_counts(df, text, spec, None, n_folds), docs
        tracked = min(8 * tracked, MOST_TRACKED)


def _df_bounds(n_docs: int | Column, spec: EncoderSpec) -> tuple[Column, Column]:
    """Document-frequency bounds: integers are counts, fractions are shares."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    low, high = (
        F.lit(limit) if isinstance(limit, int) else F.lit(limit) * n
        for limit in (spec.tfidf_min_df, spec.tfidf_max_df)
    )
    return low, high


def _idf(n: Column, df: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


def vocabulary(stats: DataFrame, n_docs: int | Column, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """The ``tfidf_terms`` most frequent terms within the df bounds, with idf.

    Ties are broken by the term; ``term_index`` is the alphabetical position.
    """
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    at_least, at_most = _df_bounds(n, spec)
    kept = (
        stats.filter((F.col("df") >= at_least) & (F.col("df") <= at_most))
        .orderBy(F.desc("tf"), F.asc("term"))
        .limit(spec.tfidf_terms)
    )
    # At most ``tfidf_terms`` rows are left: numbering them in one task is fine.
    listed = kept.agg(F.sort_array(F.collect_list(F.struct("term", "tf", "df"))).alias("_all"))
    return listed.select(F.posexplode("_all").alias("term_index", "_t")).select(
        F.col("_t.term").alias("term"),
        "term_index",
        F.col("_t.tf").alias("tf"),
        F.col("_t.df").alias("df"),
        _idf(n, F.col("_t.df")).alias("idf"),
    )


@dataclass
class TfidfEncoding:
    """Learned vocabulary of one text column; at most ``tfidf_terms`` entries."""

    column: str
    terms: list[str]
    idf: list[float]
    spec: EncoderSpec

    @property
    def output(self) -> str:
        return f"{self.column}_tfidf"

    @property
    def names(self) -> list[str]:
        return [f"{self.column}_tfidf_{t}" for t in self.terms]

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the text by its L2-normalised tf-idf vector; no shuffle."""
        if self.column not in df.columns:
            return df
        if not self.terms:
            return df.drop(self.column)
        counted = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_tf")
        weighted = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_weight"
        )
        unit = Normalizer(p=2.0, inputCol="_weight", outputCol=self.output)
        out = with_terms(df, self.column, self.spec, "_terms")
        for stage in (counted, weighted, unit):
            out = stage.transform(out)
        return out.drop("_terms", "_tf", "_weight", self.column)

    def long(self, df: DataFrame) -> DataFrame:
        """One row per document and kept term: ``term`` and ``tfidf``."""
        keep = [c for c in df.columns if c != self.column]
        if not self.terms:
            nothing = df.limit(0)
            return nothing.select(*keep, F.lit("").alias("term"), F.lit(0.0).alias("tfidf"))
        # Only terms of the vocabulary are sorted and counted, inside the row.
        kept = F.filter("_all", lambda t: t.isin(*self.terms))
        idf = F.create_map(*[F.lit(x) for pair in zip(self.terms, self.idf) for x in pair])
        return (
            with_terms(df, self.column, self.spec, "_all")
            .select(*keep, F.sort_array(kept).alias("_ordered"))
            .withColumn("_starts", run_starts(F.col("_ordered")))
            .withColumn("_counts", run_lengths(F.col("_ordered"), F.col("_starts")))
            .withColumn("_weights", F.transform("_counts", lambda c: F.struct(c["term"].alias("term"), (c["tf"] * idf[c["term"]]).alias("w"))))
            .withColumn("_norm", F.sqrt(F.aggregate("_weights", F.lit(0.0), lambda s, e: s + e["w"] * e["w"])))
            # The outer form, as in ``_counted``: no repeated chain in a test for empty arrays.
            .select(*keep, "_norm", F.inline_outer("_weights"))
            .filter(F.col("term").isNotNull())
            .select(*keep, "term", (F.col("w") / F.col("_norm")).alias("tfidf"))
        )


def fit_tfidf(df: DataFrame, text: str, spec: EncoderSpec = EncoderSpec()) -> TfidfEncoding:
    """Learn the vocabulary; every document counts, empty ones included."""
    return fit_tfidf_folds(df.drop("first_train_fold"), text, 1, spec)[0]


def fit_tfidf_folds(df: DataFrame, text: str, n_folds: int, spec: EncoderSpec = EncoderSpec()) -> list[TfidfEncoding]:
    """The vocabulary of every fold, from the rows that it trains on; the texts are read as often as for one.

    ``df`` carries ``first_train_fold``, unless there is one fold of all rows.
    """
    require(df, [text])
    stats, docs = frequent_stats(df, text, spec, n_folds)
    n = F.create_map(*[F.lit(x) for pair in docs.items() for x in pair])[F.col("fold")] if docs else F.lit(0)
    at_least, at_most = _df_bounds(F.col("docs"), spec)
    place = F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("tf"), "term"))
    kept = stats.withColumn("docs", n).filter((F.col("df") >= at_least) & (F.col("df") <= at_most))
    chosen = kept.withColumn("place", place).filter(F.col("place") <= spec.tfidf_terms)
    rows = chosen.select("fold", "term", _idf(F.col("docs"), F.col("df")).alias("idf")).collect()
    rows = sorted(rows, key=lambda r: r["term"].encode())
    out = []
    for fold in range(n_folds):
        mine = [r for r in rows if r["fold"] == fold]
        out.append(TfidfEncoding(text, [r["term"] for r in mine], [r["idf"] for r in mine], spec))
    return out


@dataclass
class HashEncoding:
    """Signed one-hot hash of the whole text; nothing is learned."""

    column: str
    spec: EncoderSpec

    @property
    def output(self) -> str:
        return f"{self.column}_hash"

    @property
    def names(self) -> list[str]:
        return [f"{self.column}_hash_{i}" for i in range(self.spec.hash_buckets)]

    def long(self, df: DataFrame) -> DataFrame:
        bucket, sign = bucket_and_sign(
            self.column, F.col(self.column), self.spec.hash_buckets, self.spec.hash_signed
        )
        return df.withColumns({"bucket": bucket, "sign": sign}).drop(self.column)

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the text by a sparse vector with one entry of 1 or -1."""
        if self.column not in df.columns:
            return df
        size = self.spec.hash_buckets
        one_hot = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(size)], inputCol="_bucket", outputCol="_plus"
        )
        flip = ElementwiseProduct(scalingVec=Vectors.dense([-1.0] * size), inputCol="_plus", outputCol="_minus")
        hashed = self.long(df).withColumn("_bucket", F.array(F.col("bucket").cast("string")))
        both = flip.transform(one_hot.transform(hashed))
        signed = F.when(F.col("sign") < 0, F.col("_minus")).otherwise(F.col("_plus"))
        return both.withColumn(self.output, signed).drop("_bucket", "_plus", "_minus", "bucket", "sign")
