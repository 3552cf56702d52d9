"""License scan by a positional index of rare words, in DataFrame functions only.

Every template has a key phrase within its notice. Words and places of the key
phrases are the postings of the index; how rare each word is comes from the
document frequencies of the whole corpus. For a file, the rarest index words it
has are looked up, and in any case the rarest word of each template, without
which its key phrase cannot stand there. Each posting turns a place in the file
into the place where the phrase would begin; where all looked-up words of a
template agree, the key phrase is verified word for word, so no place is lost
and none is wrong. The phrases of the base labels are templates of their own.

Files without any template's rarest word are done after the lookup. No text is
shuffled. Defined results: a null or empty text has no words, no labels and
score zero; repeated rows are scanned alike; an empty table stays empty; other
columns are kept, and columns named like the results are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases of the base labels.
BASE = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}
#: Label to (notice, key phrase that must stand at its place in the notice).
NOTICES = {
    "gpl-3.0": ("licensed under the gnu general public license version 3", "gnu general public license version 3"),
    "gpl-2.0": ("licensed under the gnu general public license version 2", "gnu general public license version 2"),
    "lgpl": ("licensed under the gnu lesser general public license", "gnu lesser general public license"),
    "agpl": ("licensed under the gnu affero general public license", "gnu affero general public license"),
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license version 2 0"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc 4 0"),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", "cc by sa 4 0"),
    "cc-by-4.0": ("licensed under cc by 4 0", "cc by 4 0"),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
}
#: Index words that are looked up for a file.
LOOKED_UP = 8
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TEMPLATES = {label: (phrase.split(), phrase.split()) for label, phrase in BASE.items()}
TEMPLATES |= {label: (notice.split(), key.split()) for label, (notice, key) in NOTICES.items()}
VOCABULARY = sorted({w for _, key in TEMPLATES.values() for w in key})


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, WORD_GAP), lambda w: w != "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rarity(tokens: DataFrame, words: str) -> dict[str, float]:
    """Inverse document frequency of every index word over all documents."""
    found = tokens.select(F.explode(F.array_intersect(_strings(VOCABULARY), F.col(words))).alias("word"))
    seen = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    # The words in most documents are the same for any number of documents, so no total is needed.
    most = max(seen.values(), default=1)
    return {w: math.log((1 + most) / (1 + seen.get(w, 0))) for w in VOCABULARY}


def _aligned(label: str, at: Column, chosen: Column) -> Column:
    """Beginnings of the template's key phrase on which all its looked-up words agree."""
    _, key = TEMPLATES[label]
    lists = []
    for word in sorted(set(key)):
        starts = [F.transform(_places(at, word), _minus(k)) for k, w in enumerate(key) if w == word]
        lists.append(F.when(F.array_contains(chosen, word), reduce(F.array_union, starts)))
    found = F.filter(F.array(*lists), lambda x: x.isNotNull())
    rest = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    agreed = F.aggregate(rest, F.get(found, F.lit(0)), lambda a, b: F.array_intersect(a, b))
    return F.coalesce(agreed, F.array().cast("array<int>"))


def _places(at: Column, word: str) -> Column:
    return F.transform(F.filter(at, lambda p: p["word"] == word), lambda p: p["place"])


def _minus(k: int):
    return lambda p: p - k


def _verified(label: str) -> Column:
    """Places of the template's key phrase in the file, found through the index."""
    _, key = TEMPLATES[label]
    starts = F.filter(_aligned(label, F.col("__at"), F.col("__chosen")), lambda p: p >= 0)
    return F.sort_array(F.filter(starts, lambda p: F.slice(F.col("__words"), p + 1, F.lit(len(key))) == _strings(key)))


def _covered(label: str, places: Column) -> Column:
    """Greatest share of the notice's words that stand around any place of its key phrase."""
    notice, key = TEMPLATES[label]
    begin = next(k for k in range(len(notice)) if notice[k : k + len(key)] == key)

    def share(place: Column) -> Column:
        there = [F.when(F.get(F.col("__words"), place + (k - begin)) == w, F.lit(1)).otherwise(F.lit(0)) for k, w in enumerate(notice)]
        return reduce(Column.__add__, there) / len(notice)

    # Where the key phrase is the whole notice, every place has all of it.
    return F.when(F.size(places) > 0, F.lit(1.0) if notice == key else F.array_max(F.transform(places, share)))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, per base label the places of its phrase (``base``), other labels (``notices``) and ``score``."""
    body = docs.withColumn("__words", words_of(F.col(f"`{text}`")))
    idf = rarity(body.select("__words"), "__words")
    rare_first = sorted(VOCABULARY, key=lambda w: (-idf[w], w))
    anchors = sorted({min(key, key=rare_first.index) for _, key in TEMPLATES.values()})
    words = F.col("__words")
    rare = F.slice(F.array_intersect(_strings(rare_first), words), 1, LOOKED_UP)
    looked_up = body.withColumn("__anchors", F.array_intersect(_strings(anchors), words))
    looked_up = looked_up.withColumn("__chosen", F.when(F.size("__anchors") > 0, F.array_union(rare, F.col("__anchors"))))
    numbered = F.transform(words, lambda w, k: F.struct(w.alias("word"), k.alias("place")))
    placed = F.filter(numbered, lambda p: F.array_contains(F.col("__chosen"), p["word"]))
    positions = looked_up.withColumns(
        {"n_words": F.size(words).cast("long"), "__at": F.when(F.col("__chosen").isNotNull(), placed)}
    )
    verified = F.struct(*[_verified(label).alias(label) for label in TEMPLATES])
    labelled = positions.withColumn("__found", F.when(F.col("__at").isNotNull(), verified))
    found = F.col("__found")
    base = F.struct(*[F.coalesce(found[label], F.array().cast("array<int>")).alias(label) for label in BASE])
    notices = F.array_compact(F.array(*[F.when(F.size(found[label]) > 0, F.lit(label)) for label in NOTICES]))
    covered = F.greatest(*[F.coalesce(_covered(label, found[label]), F.lit(-1.0)) for label in TEMPLATES])
    score = F.when(covered >= 0, 0.5 + covered / 2).otherwise(0.0)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "base", "notices", "score")]
    return labelled.select(*kept, "n_words", base.alias("base"), notices.alias("notices"), score.alias("score"))
