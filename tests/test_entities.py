from pyspark.sql import functions as F

from storyloom import lexicons
from storyloom.functions import entities as ent
from storyloom.operators.entity_ranking import top_entities

TEXTS = [
    "Equifax and Experian broke the FCRA, Section 609 and section two. Fair Credit Reporting act!",
    "Bank of America in New York took $1,234.50 from me; Chase too. Chase again. Chased away.",
    "The Consumer Financial Protection Bureau (CFPB) wrote.", "", None, "Transunion equifax [MASK]",
]


def extracted(spark, **options):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, narrative string")
    return ent.add_entities(df, **options)


def test_default_rules(spark):
    got = [r.entities for r in extracted(spark).orderBy("i").collect()]
    assert got[0] == {"ORG": ["Equifax", "Experian"], "LAW": ["FCRA", "Fair Credit Reporting act", "Section 609", "section two"]}
    assert got[1] == {"ORG": ["Bank of America", "Chase"], "GPE": ["New York"], "MONEY": ["$1,234.50"]}
    assert got[2] == {"ORG": ["CFPB", "Consumer Financial Protection Bureau"]}
    assert got[3] == got[4] == got[5] == {}


def test_counts(spark):
    rows = extracted(spark).orderBy("i").collect()
    assert [(r.entity_count, r.org_count, r.law_count, r.money_count, r.gpe_count) for r in rows[:4]] == [
        (6, 2, 4, 0, 0), (4, 2, 0, 1, 1), (2, 2, 0, 0, 0), (0, 0, 0, 0, 0),
    ]
    types = extracted(spark).where("i = 0").select(ent.count_entity_types(F.col("entities"))).first()[0]
    assert types == {"ORG": 2, "LAW": 4}


def test_rule_sets(spark):
    text = "Nelnet, Comenity, TILA, FCRA; fair debt collection"
    df = spark.createDataFrame([(text,)], "narrative string")
    of = lambda rules: ent.add_entities(df, rules=rules).first().entities
    assert of(ent.DEFAULT_RULES) == {"ORG": ["Nelnet"], "LAW": ["FCRA", "TILA"]}
    assert of(ent.EXTENDED_RULES) == {"ORG": ["Comenity", "Nelnet"], "LAW": ["FCRA", "TILA", "fair debt collection"]}
    assert of(ent.SHORT_RULES) == {"LAW": ["FCRA"]}


def test_longest_phrase_first_and_masked_matches_dropped(spark):
    rules = [ent.Rule("A", "New"), ent.Rule("B", "New York"), ent.Rule("C", r"York \[MASK\]", regex=True)]
    df = spark.createDataFrame([("New York, New Delhi. York [MASK] ",), ("York XXXX ",)], "narrative string")
    got = [r.entities for r in ent.add_entities(df, rules=rules, mask_first=True).collect()]
    assert got == [{"B": ["New York"], "A": ["New"]}, {}]


def test_normalise_stored_entities(spark):
    df = spark.sql("SELECT named_struct('LAW', array('FCRA'), 'ORG', CAST(NULL AS array<string>)) AS e UNION ALL SELECT NULL")
    got = [r[0] for r in df.select(ent.normalize_entities(ent.entities_from_struct(F.col("e")))).collect()]
    assert got == [{"LAW": ["FCRA"]}, {}]


def test_top_entities_blacklist_then_rename(spark):
    rows = [({"LAW": [" FCRA", "Fair Credit Reporting Act"]},), ({"LAW": ["TILA", "FCRA", " "]},), ({"ORG": ["X"]},), (None,)]
    df = spark.createDataFrame(rows, "entities map<string,array<string>>")
    got = top_entities(df, "LAW", 5, blacklist=("TILA",), names=lexicons.LAW_NAMES).collect()
    assert [tuple(r) for r in got] == [("FCRA", 3)]
