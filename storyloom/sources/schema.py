"""Source columns and their names in the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Header of the complaint file -> column name.
SOURCE_COLUMNS = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "narrative",
    "Company public response": "public_response",
    "Company": "company",
    "State": "state",
    "ZIP code": "zip_code",
    "Tags": "tags",
    "Consumer consent provided?": "consent",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent",
    "Company response to consumer": "response",
    "Timely response?": "timely",
    "Consumer disputed?": "disputed",
    "Complaint ID": "complaint_id",
}

SOURCE_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in SOURCE_COLUMNS])

DERIVED_TYPES = {
    "narrative_length": "int", "year": "int", "month": "int", "tokens": "array<string>",
    "processed_text": "string", "entities": "map<string,array<string>>", "entity_count": "int",
    "org_count": "int", "law_count": "int", "money_count": "int", "gpe_count": "int",
    "vader_compound": "double", "vader_neg": "double", "vader_neu": "double",
    "vader_pos": "double", "vader_label": "string", "textblob_polarity": "double",
    "textblob_subjectivity": "double", "textblob_label": "string", "word_count": "int",
    "unique_words": "int", "lexical_diversity": "double", "legal_term_count": "int",
    "uppercase_ratio": "double", "mask_count": "int",
}


def enriched_schema() -> T.StructType:
    """Schema of the finished table, in the engine's column names."""
    types = {name: "timestamp" if name == "date_received" else "string" for name in SOURCE_COLUMNS.values()}
    types.update(DERIVED_TYPES)
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in types.items()))


def rename_source(df: DataFrame) -> DataFrame:
    """Headers to engine names; columns that are not listed stay."""
    return df.withColumnsRenamed({h: n for h, n in SOURCE_COLUMNS.items() if h in df.columns})
