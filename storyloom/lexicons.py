"""Term tables. All are defaults: every operator takes its own table as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field

from storyloom.functions.symbols import symbol_names

# ---------------------------------------------------------------------------
# Must equal the original analysis for equal results.
# ---------------------------------------------------------------------------

# Stop words of the complaint domain.
DOMAIN_STOP_WORDS = (
    "xxxx xx xxxxx xx/xx/xxxx xxx company consumer complaint report account "
    "information requested please also would could should said told called spoke "
    "stated mentioned however therefore furthermore accordingly"
).split()

# The public NLTK English stop-word list.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its "
    "itself they them their theirs themselves what which who whom this that that'll "
    "these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why how all "
    "any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't "
    "shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

STOP_WORDS = sorted(set(ENGLISH_STOP_WORDS) | set(DOMAIN_STOP_WORDS))

# Terms whose presence in a narrative counts as a legal signal.
LEGAL_TERMS = [
    "FCRA", "FDCPA", "FCBA", "ECOA", "TILA", "violation", "violated", "compliance",
    "dispute", "validation", "verification", "investigate", "lawsuit", "litigation",
    "attorney", "fraud", "fraudulent", "identity theft",
]

# The wider legal list.
LEGAL_TERMS_EXTENDED = [
    "FCRA", "FDCPA", "FCBA", "ECOA", "TILA",
    "Section 609", "Section 611", "Section 1681",
    "Fair Credit Reporting Act", "Fair Debt Collection Practices Act",
    "violation", "violated", "compliance", "non-compliance",
    "dispute", "validation", "verification", "investigate",
    "lawsuit", "litigation", "attorney", "legal action",
    "fraud", "fraudulent", "identity theft",
]

# The short legal and ORG lists of the step-by-step variant.
LEGAL_TERMS_SHORT = [
    "FCRA", "FDCPA", "violation", "violated", "compliance", "dispute", "validation",
    "verification", "investigate", "lawsuit", "litigation", "attorney", "fraud",
    "fraudulent", "identity theft",
]
ORG_PHRASES_SHORT = [
    "Equifax", "Experian", "TransUnion", "CFPB", "IRS", "FTC", "PennyMac", "Navient",
    "Chase", "Bank of America", "Wells Fargo", "Capital One", "Discover", "Synchrony",
]
LAW_PHRASES_SHORT = ["FCRA", "FDCPA"]

# Legal words counted among the tokens by the term-frequency mart.
LEGAL_TOKENS = (
    "fcra fdcpa fcba ecoa tila fraud violation lawsuit dispute investigation inaccurate "
    "unauthorized breach discrimination harassment garnishment repossession foreclosure"
).split()

# Company names recognised as ORG.
ORG_PHRASES = [
    "Equifax", "Experian", "TransUnion", "FICO", "VantageScore", "CFPB",
    "Consumer Financial Protection Bureau", "IRS", "FTC", "PennyMac", "Navient",
    "Nelnet", "Great Lakes", "Sallie Mae", "Citibank", "Chase", "Bank of America",
    "Wells Fargo", "Capital One", "Discover", "American Express", "Synchrony",
]
ORG_PHRASES_EXTENDED = ORG_PHRASES + [
    "Federal Trade Commission", "Department of Education", "Comenity", "Portfolio Recovery",
]

# Acronyms recognised as LAW.
LAW_PHRASES = ["FCRA", "FDCPA", "FCBA", "ECOA", "TILA"]

# Company response -> category.
RESPONSE_CATEGORIES = {
    "Closed with explanation": "explanation",
    "Closed with non-monetary relief": "relief_non_monetary",
    "Closed with monetary relief": "relief_monetary",
    "Untimely response": "untimely",
    "Closed": "closed",
    "In progress": "in_progress",
}

# Words never shown in term charts.
CHART_STOP_WORDS = ["mask", "xxxx", "x", "xx", "xxx", "xxxxxxxxxxx"]

# ORG values that are noise.
ORG_NOISE = [
    "XXXX", "U.S.C", "U.S.C 1681", "USC", "CFPB", "Consumer Financial Protection Bureau",
    "the Federal Trade Commission", "NEVER", "Sections 609", "Social Security",
    "Federal", "United States",
]

# LAW spelling -> canonical name.
LAW_NAMES = {
    "Fair Credit Reporting Act": "FCRA",
    "Fair Credit Reporting act": "FCRA",
    "fair credit reporting act": "FCRA",
    "the Fair Debt Collection Practices Act": "FDCPA",
    "Fair Debt Collection Practices Act": "FDCPA",
    "Section 2": "Sec. 2",
    "section 2": "Sec. 2",
    "section 602": "Sec. 602",
    "Section 602": "Sec. 602",
    "section 604": "Sec. 604",
    "Section 604": "Sec. 604",
    "section 1637": "Sec. 1637",
}

# Sentiment labels, most negative first.
SENTIMENT_LABELS = ["Muy Negativo", "Negativo", "Neutral", "Positivo", "Muy Positivo"]

# Columns preferred as the text column of a text-quality job, in order.
TEXT_COLUMN_NAMES = [
    "descripcion", "descripcion_hecho", "observaciones", "observacion",
    "descripcion_hechos", "detalle", "texto", "description",
]

# ---------------------------------------------------------------------------
# Seed tables of our own. Small by design; pass full tables for production.
# ---------------------------------------------------------------------------

# Words that read as numbers in "section one".
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen "
    "fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
    "sixty seventy eighty ninety hundred thousand million billion"
).split()

US_STATES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
    "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
    "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island",
    "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
    "Washington", "West Virginia", "Wisconsin", "Wyoming",
]

# Irregular forms -> lemma.
LEMMAS = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be", "been": "be",
    "has": "have", "had": "have", "does": "do", "did": "do", "done": "do",
    "went": "go", "gone": "go", "said": "say", "told": "tell", "paid": "pay",
    "sent": "send", "made": "make", "took": "take", "taken": "take", "gave": "give",
    "given": "give", "got": "get", "gotten": "get", "knew": "know", "known": "know",
    "found": "find", "kept": "keep", "left": "leave", "lost": "lose", "bought": "buy",
    "sold": "sell", "brought": "bring", "thought": "think", "felt": "feel", "held": "hold",
    "heard": "hear", "wrote": "write", "written": "write", "spoke": "speak",
    "spoken": "speak", "stole": "steal", "stolen": "steal", "began": "begin",
    "begun": "begin", "became": "become", "came": "come", "saw": "see", "seen": "see",
    "understood": "understand", "men": "man", "women": "woman", "children": "child",
    "people": "people", "worse": "bad", "worst": "bad", "better": "good", "best": "good",
}

# Suffix rules (pattern, replacement), tried in order; the first that matches is used. "Holds a vowel
# before" is written by the first vowel, so that a pattern takes time in proportion to the word.
_DOUBLED = "bdgklmnprt"
LEMMA_SUFFIXES = [
    (r"^(.{2,})ies$", "$1y"),
    (r"^(.+(?:ss|sh|ch|x|zz))es$", "$1"),
    (r"^(.+[^su])s$", "$1"),
    (r"^(.{2,})ied$", "$1y"),
    *[(rf"^([^aeiouy]*[aeiouy].*{c}){c}ed$", "$1") for c in _DOUBLED],
    (r"^([^aeiouy]*[aeiouy].*(?:at|iz|ov|iv|uc|ut|ng|rg|dg|us|os))ed$", "$1e"),
    (r"^([^aeiouy]*[aeiouy].*[^e])ed$", "$1"),
    *[(rf"^([^aeiouy]*[aeiouy].*{c}){c}ing$", "$1") for c in _DOUBLED],
    (r"^([^aeiouy]*[aeiouy].*(?:at|iz|ov|iv|uc|ut|rg|dg|us|os))ing$", "$1e"),
    (r"^([^aeiouy]*[aeiouy].*)ing$", "$1"),
]


@dataclass(frozen=True)
class SentimentLexicon:
    """Word tables of both scorers. Keys are lower case."""

    valence: dict = field(default_factory=dict)  # word -> -4..4
    tone: dict = field(default_factory=dict)  # word -> (polarity, subjectivity)
    boosters: dict = field(default_factory=dict)  # word -> scalar added to the next word
    intensity: dict = field(default_factory=dict)  # word -> factor on the next word's tone
    negations: frozenset = frozenset()
    idioms: dict = field(default_factory=dict)  # phrase of 2 or 3 words -> valence
    phrase_boosters: dict = field(default_factory=dict)  # phrase -> scalar
    contrast: str = "but"
    symbols: dict = field(default_factory=dict)  # emoji or other symbol sequence -> its words


_UP, _DOWN = 0.293, -0.293  # published booster scalars

SENTIMENT = SentimentLexicon(
    valence={
        "good": 1.9, "great": 3.1, "excellent": 2.7, "happy": 2.7, "helpful": 1.8,
        "help": 1.7, "thank": 1.5, "thanks": 1.9, "best": 3.2, "better": 1.9, "nice": 1.8,
        "kind": 2.4, "love": 3.2, "like": 1.5, "please": 1.3, "pleased": 1.9, "fair": 1.3,
        "resolve": 0.7, "resolved": 0.7, "protect": 1.6, "protection": 1.2, "trust": 2.3,
        "honest": 2.3, "credit": 1.6, "approved": 1.8, "agree": 1.5, "benefit": 2.0,
        "bad": -2.5, "worst": -3.1, "worse": -2.1, "terrible": -2.1, "horrible": -2.5,
        "awful": -2.0, "fraud": -2.8, "fraudulent": -2.7, "scam": -2.7, "theft": -2.5,
        "stolen": -2.2, "steal": -2.2, "lie": -1.6, "lied": -1.6, "lying": -2.4,
        "angry": -2.3, "upset": -1.6, "frustrated": -2.4, "frustrating": -1.9,
        "harassment": -2.5, "harass": -2.2, "threat": -2.4, "threaten": -1.6,
        "problem": -1.7, "problems": -1.7, "error": -1.7, "errors": -1.4, "wrong": -2.1,
        "illegal": -2.6, "violation": -2.2, "violated": -2.4, "unfair": -2.1,
        "damage": -2.2, "debt": -1.5, "loss": -1.3, "lost": -1.3, "refuse": -1.2,
        "refused": -1.2, "denied": -1.9, "deny": -1.4, "dispute": -1.7, "disputed": -1.4,
        "complaint": -1.2, "complain": -1.5, "stress": -1.8, "victim": -1.1, "no": -1.2,
    },
    tone={
        "good": (0.7, 0.6), "great": (0.8, 0.75), "excellent": (1.0, 1.0),
        "happy": (0.8, 1.0), "nice": (0.6, 1.0), "kind": (0.6, 0.9), "best": (1.0, 0.3),
        "better": (0.5, 0.5), "fair": (0.7, 0.9), "honest": (0.6, 0.9), "bad": (-0.7, 0.67),
        "worst": (-1.0, 1.0), "worse": (-0.4, 0.6), "terrible": (-1.0, 1.0),
        "horrible": (-1.0, 1.0), "awful": (-1.0, 1.0), "wrong": (-0.5, 0.9),
        "illegal": (-0.5, 0.5), "unfair": (-0.5, 1.0), "angry": (-0.5, 1.0),
        "frustrated": (-0.7, 0.2), "fraudulent": (-0.5, 0.5), "false": (-0.4, 0.6),
    },
    boosters={
        **dict.fromkeys(
            "absolutely amazingly awfully completely considerably decidedly deeply "
            "enormously entirely especially exceptionally extremely fully greatly highly "
            "hugely incredibly intensely majorly more most particularly purely quite really "
            "remarkably so substantially thoroughly totally tremendously truly unbelievably "
            "unusually utterly very".split(), _UP),
        **dict.fromkeys(
            "almost barely hardly kinda less little marginally occasionally partly scarcely "
            "slightly somewhat sorta".split(), _DOWN),
    },
    intensity={
        "very": 1.3, "really": 1.3, "extremely": 1.4, "so": 1.2, "quite": 1.2,
        "totally": 1.3, "slightly": 0.7, "somewhat": 0.8, "almost": 0.8,
    },
    negations=frozenset(
        "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't "
        "daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't "
        "hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not "
        "nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't "
        "uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite".split()),
    idioms={
        "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0,
        "beating heart": 3.1, "broken heart": -2.9, "upper hand": 1.0, "hand to mouth": -2.0,
    },
    phrase_boosters={
        "kind of": _DOWN, "sort of": _DOWN, "just enough": _DOWN,
    },
    symbols=symbol_names(),
)
