"""Emoji and other symbol sequences as words, by longest match over a tree of symbols."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from storyloom.functions.let import let
from storyloom.functions.lookup import hash_lookup

# Blocks whose characters have their Unicode name as words.
BLOCKS = ((0x2600, 0x27BF), (0x1F300, 0x1FAFF))
# The published short names of the five skin tones, from U+1F3FB on.
TONES = ("light skin tone", "medium-light skin tone", "medium skin tone", "medium-dark skin tone", "dark skin tone")
FIRST_TONE = 0x1F3FB
TONE_CLASS = r"[\x{1F3FB}-\x{1F3FF}]"
# Presentation selector and joiner, which say nothing where no table entry spans them.
GLUE_CLASS = r"[\x{FE0F}\x{200D}]"
# Put before each word of a name where the caller must tell them from the text's own words.
MARK = "\ue000"


@cache
def symbol_names() -> dict[str, str]:
    """Words of single symbols: their Unicode names in lower case, as this Python's Unicode version has them."""
    names = {chr(FIRST_TONE + i): name for i, name in enumerate(TONES)}
    for low, high in BLOCKS:
        for point in range(low, high + 1):
            name = unicodedata.name(chr(point), "")
            if name:
                names.setdefault(chr(point), name.lower())
    return names


def _class(points: list[int]) -> str:
    """A character class of code points, as ranges."""
    ranges: list[list[int]] = []
    for p in sorted(points):
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    spell = lambda a, z: rf"\x{{{a:X}}}" if a == z else rf"\x{{{a:X}}}-\x{{{z:X}}}"
    return "[" + "".join(spell(a, z) for a, z in ranges) + "]"


def tree_pattern(keys) -> str:
    """A pattern of the longest key at a place. Keys share the way to where they part, so none is tried twice."""
    root: dict = {}
    for key in keys:
        node = root
        for ch in key:
            node = node.setdefault(ch, {})
        node[""] = {}

    def spell(node: dict) -> str:
        by_rest: dict[str, list[int]] = {}
        for ch, child in node.items():
            if ch:
                by_rest.setdefault(spell(child), []).append(ord(ch))
        if not by_rest:
            return ""
        ways = "|".join(_class(points) + rest for rest, points in by_rest.items())
        return f"(?:{ways}){'?' if '' in node else ''}"

    return spell(root)


def describe_symbols(text: Column, names: dict[str, str], mark: str = "") -> Column:
    """The text with every symbol of the table replaced by its words, the longest entry at a place first.

    A name gets a space in front unless one stands there or the text begins, and none behind, as in the
    published scorer. A skin tone behind an entry without one of its own is added after a colon; selectors and
    joiners behind an entry go. A null text stays null. ``mark`` is put before each word of a name.
    """
    names = {k: v for k, v in names.items() if k}
    if not names:
        return text
    firsts = [ord(k[0]) for k in names]
    firsts_class, tree = _class(firsts), tree_pattern(names)
    piece = rf"{tree}{TONE_CLASS}?{GLUE_CLASS}*+|[^{firsts_class[1:]}++|[\s\S]"
    marked = {k: " ".join(mark + w for w in v.split()) for k, v in names.items()}
    find = hash_lookup(marked, "string")
    tones = hash_lookup({chr(FIRST_TONE + i): " ".join(mark + w for w in t.split()) for i, t in enumerate(TONES)}, "string")

    def name(p: Column) -> Column:
        bare = F.regexp_replace(p, GLUE_CLASS + "+$", "")
        toned = F.regexp_replace(bare, f"(?<=[\\s\\S]){TONE_CLASS}$", "")
        tone = F.concat(F.lit(": "), tones(F.right(bare, F.lit(1))))
        ways = [(p, F.lit("")), (bare, F.lit("")), (toned, tone), (F.regexp_replace(toned, GLUE_CLASS + "+$", ""), tone)]
        tried = F.array(*(F.struct(k.alias("k"), end.alias("end")) for k, end in ways))
        found = F.transform(tried, lambda w: F.concat(find(w["k"]), w["end"]))
        return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))

    def join(pieces: Column) -> Column:
        def spelled(p, i):
            before = F.get(pieces, i - 1)
            gap = F.when((i == 0) | F.endswith(before, F.lit(" ")), "").otherwise(" ")
            return F.coalesce(F.concat(gap, F.when(F.rlike(p, F.lit(f"^{firsts_class}")), name(p))), p)

        return F.array_join(F.transform(pieces, spelled), "")

    # one range settles most texts
    span = rf"[\x{{{min(firsts):X}}}-\x{{{max(firsts):X}}}]"
    described = let(F.regexp_extract_all(text, F.lit(piece), F.lit(0)), join)
    return F.when(F.rlike(text, F.lit(span)), described).otherwise(text)
