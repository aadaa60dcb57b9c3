"""Rule-based entities: one regular expression pass over the raw text, no shuffle."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.let import let
from storyloom.functions.text import MASK, WORD_AFTER, WORD_BEFORE, mask_redactions

ENTITY_TYPE = "map<string,array<string>>"


@dataclass(frozen=True)
class Rule:
    """A phrase (matched as written) or, with ``regex``, a pattern."""

    label: str
    pattern: str
    regex: bool = False

    @property
    def expression(self) -> str:
        return self.pattern if self.regex else re.escape(self.pattern)


def phrases(label: str, names) -> list[Rule]:
    return [Rule(label, n) for n in names]


# Possessive repeats run as a loop, so a number may have any count of groups.
_NUMBER = r"(?:\d++(?:[.,/]\d++)*+|(?i:" + "|".join(lexicons.NUMBER_WORDS) + "))"

_LAW_PATTERNS = [
    Rule("LAW", r"(?i:section)\s+" + _NUMBER, regex=True),
    Rule("LAW", r"(?i:fair\s+credit\s+reporting\s+act)", regex=True),
]
LAW_RULES = phrases("LAW", lexicons.LAW_PHRASES) + _LAW_PATTERNS
LAW_RULES_EXTENDED = LAW_RULES + [Rule("LAW", r"(?i:fair\s+debt\s+collection)", regex=True)]
MONEY_RULES = [Rule("MONEY", r"\$\s?\d++(?:,\d{3})*+(?:\.\d+)?(?:\s(?i:thousand|million|billion))?", regex=True)]

DEFAULT_RULES = (
    phrases("ORG", lexicons.ORG_PHRASES) + LAW_RULES + MONEY_RULES + phrases("GPE", lexicons.US_STATES)
)
EXTENDED_RULES = (
    phrases("ORG", lexicons.ORG_PHRASES_EXTENDED)
    + LAW_RULES_EXTENDED
    + MONEY_RULES
    + phrases("GPE", lexicons.US_STATES)
)
SHORT_RULES = (
    phrases("ORG", lexicons.ORG_PHRASES_SHORT)
    + phrases("LAW", lexicons.LAW_PHRASES_SHORT)
    + _LAW_PATTERNS
    + MONEY_RULES
    + phrases("GPE", lexicons.US_STATES)
)


def in_match_order(rules) -> list[Rule]:
    """Phrases first, longest first; then patterns as listed. First that matches wins."""
    fixed = sorted((r for r in rules if not r.regex), key=lambda r: -len(r.pattern))
    return fixed + [r for r in rules if r.regex]


def alternation(rules) -> str:
    body = "|".join(r.expression for r in in_match_order(rules))
    return f"{WORD_BEFORE}(?:{body}){WORD_AFTER}"


def label_of(match: Column, rules) -> Column:
    """Label of a matched text: hash-set tests for phrases, then each pattern."""
    ordered = in_match_order(rules)
    by_label: dict[str, list[str]] = {}
    for r in ordered:
        if not r.regex:
            by_label.setdefault(r.label, []).append(r.pattern)
    branch = None
    for label, names in by_label.items():
        test = match.isin(*names)
        branch = F.when(test, label) if branch is None else branch.when(test, label)
    for r in ordered:
        if r.regex:
            test = match.rlike(f"^(?:{r.pattern})$")
            branch = F.when(test, r.label) if branch is None else branch.when(test, r.label)
    return branch


def entities_of(text: Column, rules=None, mask_first: bool = False) -> Column:
    """Map of label -> sorted distinct texts; empty for a blank text."""
    rules = DEFAULT_RULES if rules is None else rules
    c = F.coalesce(text, F.lit(""))
    if mask_first:
        c = mask_redactions(c)
    found = F.regexp_extract_all(c, F.lit(alternation(rules)), F.lit(0))
    found = F.filter(F.array_distinct(found), lambda m: ~F.contains(m, F.lit(MASK)))
    typed = F.transform(found, lambda m: F.struct(label_of(m, rules).alias("label"), m.alias("text")))
    labels = list(dict.fromkeys(r.label for r in rules))

    def grouped(pairs):
        def of(label):
            return F.array_sort(F.transform(F.filter(pairs, lambda e: e["label"] == label), lambda e: e["text"]))

        every = F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*map(of, labels)))
        return F.map_filter(every, lambda k, v: F.size(v) > 0)

    return let(typed, grouped)


def add_entities(
    df: DataFrame, text: str = "narrative", rules=None, mask_first: bool = False, counts: bool = True
) -> DataFrame:
    """Add ``entities`` and the per-label counts."""
    out = df.withColumn("entities", entities_of(F.col(text), rules, mask_first))
    return add_entity_counts(out) if counts else out


def label_count(entities: Column, label: str) -> Column:
    return F.coalesce(F.size(F.try_element_at(entities, F.lit(label))), F.lit(0))


def entity_count(entities: Column) -> Column:
    return F.aggregate(F.map_values(entities), F.lit(0), lambda n, v: n + F.size(v))


def count_entity_types(entities: Column) -> Column:
    return F.transform_values(entities, lambda k, v: F.size(v))


def add_entity_counts(df: DataFrame) -> DataFrame:
    e = F.col("entities")
    return df.withColumns(
        {
            "entity_count": entity_count(e),
            "org_count": label_count(e, "ORG"),
            "law_count": label_count(e, "LAW"),
            "money_count": label_count(e, "MONEY"),
            "gpe_count": label_count(e, "GPE"),
        }
    )


def normalize_entities(entities: Column) -> Column:
    """Null map -> empty map, null list -> empty list."""
    empty = F.from_json(F.lit("{}"), ENTITY_TYPE)
    return F.transform_values(
        F.coalesce(entities, empty), lambda k, v: F.coalesce(v, F.array().cast("array<string>"))
    )


def entities_from_struct(entities: Column) -> Column:
    """Entities read from a file that stored them as a struct of lists, as a map."""
    return F.from_json(F.to_json(entities), ENTITY_TYPE)
