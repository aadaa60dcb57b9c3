"""Report tables over the enriched narratives. Each takes the table and a filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.text import clip, ellipsis, long_enough, short_product
from storyloom.operators import topk
from storyloom.operators.entity_ranking import entity_mentions, top_entities
from storyloom.operators.histogram import histogram
from storyloom.operators.profile import yearly_counts
from storyloom.operators.quantiles import one_quantile
from storyloom.operators.sampling import sample_uniform
from storyloom.plans.filters import ALL, Filters, select_present

LABELS = lexicons.SENTIMENT_LABELS
NONE = "—"


def _rank(label: Column, labels=LABELS) -> Column:
    return F.array_position(F.array(*map(F.lit, labels)), label).cast("int")


def _maybe_sample(df: DataFrame, key: str | None, n: int | None) -> DataFrame:
    return df if n is None or key is None else sample_uniform(df, key, n)


# Overview ------------------------------------------------------------------


def kpis(df: DataFrame, filters: Filters = ALL, labels=LABELS) -> DataFrame:
    """One row: rows, % negative, top issue, top company, median tokens, % with a legal term.

    The table is read once, for counts by issue, by company, by token count and over all; every figure comes from those few
    rows (different token counts are no more than the longest text has words). Without rows the count is 0,
    the tops are a dash and the other figures null.
    """
    columns = [F.col(c) for c in ("issue", "company", "word_count")]
    counts = filters.apply(df).groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("vader_label").isin(*labels[:2])).alias("negative"),
        F.count_if(F.col("legal_term_count") > 0).alias("legal"),
    )
    by_issue, by_company, by_tokens, all_ = (F.col("_g") == g for g in (0b011, 0b101, 0b110, 0b111))

    def first(group: Column, name: str) -> Column:
        best = F.min(F.when(group & F.col(name).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(name).alias("value"))))
        return F.coalesce(ellipsis(best["value"], 22, 22), F.lit(NONE)).alias(f"top_{name}")

    share = lambda c: F.try_divide(F.max(F.when(all_, F.col(c))) * F.lit(100.0), F.max(F.when(all_, F.col("n"))))
    tokens, rows = F.when(by_tokens, F.col("word_count")), F.when(by_tokens, F.col("n")).otherwise(0)
    return counts.agg(
        F.coalesce(F.max(F.when(all_, F.col("n"))), F.lit(0)).alias("n_rows"),
        share("negative").alias("negative_pct"),
        first(by_issue, "issue"),
        first(by_company, "company"),
        F.percentile(tokens, F.lit(0.5), rows).cast("int").alias("median_tokens"),
        share("legal").alias("legal_pct"),
    )


def timeline(df: DataFrame, filters: Filters = ALL) -> DataFrame:
    return yearly_counts(filters.apply(df))


def products(df: DataFrame, filters: Filters = ALL, k: int = 8) -> DataFrame:
    """Top products under their short label; equal labels are added up."""
    top = topk.top_k(filters.apply(df), "product", k)
    return top.groupBy(short_product(F.col("product")).alias("label")).agg(F.sum("n").alias("n"))


def issues(df: DataFrame, filters: Filters = ALL, k: int = 10) -> DataFrame:
    top = topk.top_k(filters.apply(df), "issue", k)
    return top.select(ellipsis(F.col("issue"), 42, 40).alias("label"), "n")


def states(df: DataFrame, filters: Filters = ALL, k: int = 15) -> DataFrame:
    return topk.top_k(filters.apply(df), "state", k)


def responses(df: DataFrame, filters: Filters = ALL, k: int = 6) -> DataFrame:
    top = topk.top_k(filters.apply(df), "response", k)
    return top.select(ellipsis(F.col("response"), 32, 30).alias("label"), "n")


# Text ----------------------------------------------------------------------


def funnel(raw: DataFrame, enriched: DataFrame, filters: Filters = ALL, text: str = "narrative") -> DataFrame:
    """Rows that reach each stage, counted rather than stated."""
    n = filters.apply(enriched).agg(F.count(F.lit(1)).alias("n")).scalar()
    one = raw.agg(F.count(F.lit(1)).alias("loaded"), F.count_if(long_enough(F.col(text))).alias("cleaned"))
    steps = [
        ("1 raw", F.col("loaded")),
        ("2 cleaned", F.col("cleaned")),
        ("3 preprocessed", n),
        ("4 entities and sentiment", n),
        ("5 features", n),
    ]
    cells = F.array(*[F.struct(F.lit(s).alias("stage"), c.alias("n")) for s, c in steps])
    return one.select(F.inline(cells))


def cloud_terms(
    df: DataFrame, filters: Filters = ALL, k: int = 120, key: str | None = None, sample: int | None = None,
    stop=lexicons.CHART_STOP_WORDS,
) -> DataFrame:
    """Term weights of a word cloud, without mask words; over a sample only if asked for."""
    kept = _maybe_sample(filters.apply(df), key, sample)
    return topk.top_term_weights(kept, "tokens", k, stop)


def top_tokens(
    df: DataFrame, filters: Filters = ALL, k: int = 20, key: str | None = None, sample: int | None = None,
    stop=lexicons.CHART_STOP_WORDS,
) -> DataFrame:
    kept = _maybe_sample(filters.apply(df), key, sample)
    words = topk.long_tokens(kept).where(F.length("token") > 2)
    return topk.top_k(words.where(~F.col("token").isin(*stop)) if stop else words, "token", k)


def issue_terms(df: DataFrame, k: int = 150) -> DataFrame:
    """Term weights among rows of the most frequent issue."""
    return topk.top_term_weights(topk.keep_top(df, "issue", 1), "tokens", k)


def length_histogram(df: DataFrame, filters: Filters = ALL, cap: int = 5000, bins: int = 50) -> DataFrame:
    """Histogram of the clipped length with the median of the unclipped one."""
    kept = filters.apply(df)
    n = F.col("narrative_length")
    out = histogram(kept, clip(n, high=cap), 0, cap, bins)
    return out.withColumn("median", one_quantile(kept, n, 0.5))


def diversity_histogram(df: DataFrame, filters: Filters = ALL, bins: int = 40) -> DataFrame:
    return histogram(filters.apply(df), clip(F.col("lexical_diversity"), 0.0, 1.0), 0, 1, bins)


def word_count_boxes(df: DataFrame, filters: Filters = ALL, upto: float = 0.98, labels=LABELS) -> DataFrame:
    """Box statistics of the word count per label, rows above the 98th percentile left out.

    All comes from the rows per label and word count, of which there are no more than the longest text has words.
    """
    v, c = F.col("v"), F.col("c")
    counts = filters.apply(df).groupBy("vader_label", F.col("word_count").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counts = counts.where(v.isNotNull())
    # one row, joined to the counts of each value; the counts are shuffled once and read by all
    limit = counts.groupBy("v").agg(F.sum("c").alias("c")).agg(F.percentile(v, F.lit(float(upto)), c)).scalar()
    rows = counts.where((v <= limit) & F.col("vader_label").isin(*labels))
    of_label = rows.groupBy("vader_label").agg(
        F.percentile(v, F.array(*map(F.lit, (0.25, 0.5, 0.75))), c).alias("q"), F.sum("c").alias("n"), F.collect_set("v").alias("values")
    )
    q25, median, q75 = (F.col("q")[i] for i in range(3))
    reach = 1.5 * (q75 - q25)
    inside = F.filter("values", lambda x: x.between(q25 - reach, q75 + reach))
    return of_label.select(
        "vader_label", q25.alias("q25"), median.alias("median"), q75.alias("q75"), "n",
        F.array_min(inside).alias("low_fence"), F.array_max(inside).alias("high_fence"),
    )


# Sentiment -----------------------------------------------------------------


def label_order(df: DataFrame, filters: Filters = ALL, labels=LABELS) -> DataFrame:
    """Rows per label in display order; labels without rows are left out."""
    counts = topk.value_counts(filters.apply(df).where(F.col("vader_label").isin(*labels)), "vader_label")
    return counts.withColumn("position", _rank(F.col("vader_label"), labels)).orderBy("position")


def label_by_product(df: DataFrame, filters: Filters = ALL, k: int = 8) -> DataFrame:
    top = topk.keep_top(filters.apply(df), "product", k)
    return topk.cross_counts(top.withColumn("label", short_product(F.col("product"))), "label", "vader_label")


def label_by_year(df: DataFrame, filters: Filters = ALL) -> DataFrame:
    return topk.cross_counts(filters.apply(df), "year", "vader_label")


def compound_histogram(df: DataFrame, filters: Filters = ALL, bins: int = 60) -> DataFrame:
    return histogram(filters.apply(df), F.col("vader_compound"), -1, 1, bins)


def scorer_scatter(df: DataFrame, key: str, filters: Filters = ALL, n: int | None = 4000) -> DataFrame:
    kept = _maybe_sample(filters.apply(df), key, n)
    return kept.select(key, "vader_compound", "textblob_polarity", "vader_label")


def subjectivity_histogram(df: DataFrame, filters: Filters = ALL, bins: int = 40, labels=LABELS) -> DataFrame:
    """Subjectivity per outer and neutral label; all labels when none of those has rows."""
    kept = filters.apply(df)
    chosen = F.col("vader_label").isin(labels[0], labels[2], labels[4])
    found = kept.agg(F.coalesce(F.max(chosen), F.lit(False)).alias("any")).scalar()
    shown = kept.where(chosen | ~found)
    return histogram(shown, F.col("textblob_subjectivity"), 0, 1, bins, by=("vader_label",))


# Entities ------------------------------------------------------------------


def top_orgs(df: DataFrame, filters: Filters = ALL, k: int = 15, blacklist=lexicons.ORG_NOISE) -> DataFrame:
    return top_entities(filters.apply(df), "ORG", k, blacklist)


def top_laws(df: DataFrame, filters: Filters = ALL, k: int = 15, names=None) -> DataFrame:
    return top_entities(filters.apply(df), "LAW", k, names=lexicons.LAW_NAMES if names is None else names)


def top_gpe(df: DataFrame, filters: Filters = ALL, k: int = 15) -> DataFrame:
    return top_entities(filters.apply(df), "GPE", k)


def legal_frequencies(
    df: DataFrame, filters: Filters = ALL, key: str | None = None, sample: int | None = None,
    terms=lexicons.LEGAL_TOKENS,
) -> DataFrame:
    """Occurrences of listed terms among the tokens, fewest first."""
    words = topk.long_tokens(_maybe_sample(filters.apply(df), key, sample))
    counts = topk.value_counts(words.where(F.col("token").isin(*terms)), "token")
    return counts.orderBy("n", "token")


def label_by_org(df: DataFrame, filters: Filters = ALL, k: int = 8, blacklist=lexicons.ORG_NOISE) -> DataFrame:
    rows = entity_mentions(filters.apply(df), "ORG", blacklist, keep=("vader_label",))
    return topk.cross_counts(topk.keep_top(rows, "entity", k), "entity", "vader_label")


TABLE_COLUMNS = ("date_received", "product", "issue", "company", "vader_label", "narrative")


def narrative_sample(
    df: DataFrame, key: str, filters: Filters = ALL, n: int = 8, width: int = 250, columns=TABLE_COLUMNS
) -> DataFrame:
    """A few rows as shown in a table, long cells cut."""
    rows = sample_uniform(filters.apply(df), key, n)
    shown = select_present(rows, (key, *columns))
    cells = [ellipsis(F.col(c).cast("string"), width, width).alias(c) for c in shown.columns if c != key]
    return shown.select(key, *cells)
