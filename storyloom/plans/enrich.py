"""The whole enrichment, as one lazy plan or as restartable stages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from storyloom import lexicons
from storyloom.functions.entities import DEFAULT_RULES, add_entities
from storyloom.functions.features import add_features
from storyloom.functions.lookup import MAX_LITERAL_ENTRIES
from storyloom.functions.sentiment import add_sentiment
from storyloom.functions.text import long_enough, parse_date
from storyloom.functions.tokens import add_tokens
from storyloom.operators.joins import lookup_table
from storyloom.operators.sampling import first_rows
from storyloom.operators.word_lemmas import add_tokens_by_words
from storyloom.sources.files import load_stage, save_stage
from storyloom.sources.manifest import fingerprint, read_manifest, write_manifest


@dataclass(frozen=True)
class Tables:
    """Term tables and switches of one enrichment."""

    stop: tuple = tuple(lexicons.STOP_WORDS)
    # a dictionary, or a table (token, lemma) of any size
    lemmas: dict | DataFrame = field(default_factory=lambda: lexicons.LEMMAS)
    suffix_rules: list | None = field(default_factory=lambda: lexicons.LEMMA_SUFFIXES)
    rules: tuple = tuple(DEFAULT_RULES)
    lexicon: lexicons.SentimentLexicon = lexicons.SENTIMENT
    legal_terms: tuple = tuple(lexicons.LEGAL_TERMS)
    mask_first: bool = False
    masks: str = "raw"
    normalise: bool = True


def clean_rows(df: DataFrame, text: str = "narrative", date: str = "date_received") -> DataFrame:
    """Drop short narratives; add length, year and month; parse the date."""
    out = df.where(long_enough(F.col(text))).withColumn("narrative_length", F.length(text))
    if date in df.columns:
        out = out.withColumn(date, parse_date(F.col(date))).withColumns(
            {"year": F.year(date), "month": F.month(date)}
        )
    return out


def add_all_tokens(df: DataFrame, t: Tables, key: str = "complaint_id") -> DataFrame:
    """Tokens by expressions on the row; by a join over distinct words where the lemmas are a table, or too many for a plan.

    Both give the same tokens. The join needs ``key``, which names rows.
    """
    if isinstance(t.lemmas, DataFrame) or len(t.lemmas) > MAX_LITERAL_ENTRIES:
        table = t.lemmas if isinstance(t.lemmas, DataFrame) else lookup_table(df.sparkSession, t.lemmas, "token", "lemma")
        return add_tokens_by_words(df, key, table, normalise=t.normalise, stop=t.stop, suffix_rules=t.suffix_rules)
    return add_tokens(
        df, normalise=t.normalise, stop=t.stop, lemmas=t.lemmas, suffix_rules=t.suffix_rules
    )


def enrich(df: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """Every derived column in one pass over the narratives, without a shuffle unless the lemma table is too large for a plan."""
    out = add_all_tokens(clean_rows(df), tables)
    out = add_entities(out, rules=tables.rules, mask_first=tables.mask_first)
    out = add_sentiment(out, lex=tables.lexicon)
    return add_features(out, terms=tables.legal_terms, masks=tables.masks)


# Stage name -> what it adds to the stage before.
STAGES = {
    "00_raw": lambda df, t: df,
    "01_clean": lambda df, t: clean_rows(df),
    "02_tokens": lambda df, t: add_all_tokens(df, t),
    "03_entities": lambda df, t: add_entities(df, rules=t.rules, mask_first=t.mask_first),
    "04_sentiment": lambda df, t: add_sentiment(df, lex=t.lexicon),
    "05_features": lambda df, t: add_features(df, terms=t.legal_terms, masks=t.masks),
}


# Stage name -> the fields of ``Tables`` that decide what it adds.
MADE_WITH = {
    "02_tokens": ("stop", "lemmas", "suffix_rules", "normalise"),
    "03_entities": ("rules", "mask_first"),
    "04_sentiment": ("lexicon",),
    "05_features": ("legal_terms", "masks"),
}


def run_stages(
    spark: SparkSession,
    source: DataFrame | None,
    folder: str,
    tables: Tables = Tables(),
    key: str | None = None,
    sample: int | None = None,
    resume_from: str | None = None,
) -> tuple[DataFrame, list[dict]]:
    """Write each stage below ``folder``; return the last one and the stage reports.

    Each stage has a manifest: a digest of the source's files, plan and schema, of the tables and options that
    it uses, and of the stage before. A stage that is whole on disk and was made by the same is read back, so a run that was cut
    short goes on where it stopped, and one with another source, table or sample computes from there on.
    ``resume_from`` names the first stage to compute again in any case. Without a source the first stage
    is taken as it lies.
    """
    if sample is not None and not key:
        raise ValueError("a sample needs the key that orders it")
    current, reports, redo, parent = source, [], False, None
    for name, step in STAGES.items():
        path = f"{folder.rstrip('/')}/{name}"
        redo = redo or name == resume_from
        options = {"sample": sample, "key": key} if name == "01_clean" else {f: getattr(tables, f) for f in MADE_WITH.get(name, ())}
        if name != "00_raw":
            made_by = fingerprint(stage=name, parent=parent, options=options)
        elif source is not None:
            made_by = fingerprint(stage=name, source=source)
        else:
            made_by = read_manifest(spark, path)
        same = source is None and name == "00_raw" or read_manifest(spark, path) == made_by
        done = load_stage(spark, path) if same and not redo else None
        parent = made_by
        if done is not None:
            current = done
            continue
        redo = True
        if current is None:
            raise ValueError(f"stage {name} needs a source or an earlier stage in {folder}")
        result = step(current, tables)
        if name == "01_clean" and key:
            result = first_rows(result, key, sample)
        reports.append(save_stage(result, path))
        write_manifest(spark, path, made_by)
        current = spark.read.parquet(path)
    return current, reports
