"""Licence scan by a positional index over rare words.

Templates are short licence notices with a label and mandatory key phrases. How rare a licence word is,
is counted over all documents; each template is indexed by its rarest words, with their positions. A file looks
up those of its words, its rarest licence words, in the index; each posting says where the notice would have
to start, and starts on which several postings agree are candidates. A candidate counts if all key phrases
stand in its window; its score is the share of the notice's words that stand in place.

DataFrame functions only. One pass counts licence words (partial sums of as many rows as the templates have
words; that many rows reach the driver), another scans. Texts stay in their rows: no shuffle of them.

Defined cases: a null or empty text has no words and no labels, first_word and last_word are null and the
score is 0. Words are counted from 0; very long texts are looked up in time linear but for the sort of their
hits. Repeated rows count as often as they come and get equal results. Without documents every licence word is
equally rare. The input's columns are kept in ``row``, so names don't clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rarest words by which a template is indexed, postings that must agree, words that a key phrase may be off its place.
INDEX_WORDS, MIN_AGREEING, SLACK = 8, 2, 3
#: Least share of a notice's words in place.
MIN_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    notice: str
    keys: tuple[str, ...]


# Phrases of the base rule, and wordings of public licence notices.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license", "in compliance with the license")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license", "version 3 of the license")),
    Template("gpl-2", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license", "version 2 of the license")),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    Template("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license", ("gnu lesser general public license", "version 2 1")),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("bsd", "use of this source code is governed by a bsd style license that can be found in the license file", ("governed by a bsd style license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl-2", "made available under the terms of the eclipse public license 2 0", ("eclipse public license 2",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    Template("cc0", "licensed under cc0 1 0 universal public domain dedication", ("cc0", "public domain dedication")),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
)


def words(text: Column) -> Column:
    """Lower-case words of a text in order; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK), "")


def rarity(df: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """Number of rows whose text has a word, for each word of the vocabulary."""
    known = F.array_distinct(F.filter(words(F.col(text)), lambda w: w.isin(vocabulary)))
    held = {r.word: r["count"] for r in df.select(F.explode(known).alias("word")).groupBy("word").count().collect()}
    return {w: held.get(w, 0) for w in vocabulary}


def index(templates: tuple[Template, ...], rows_with: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, position) of each template's rarest words."""
    found: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        notice = template.notice.split()
        rare = set(sorted(set(notice), key=lambda w: (rows_with[w], w))[:INDEX_WORDS])
        for p, w in enumerate(notice):
            if w in rare:
                found.setdefault(w, []).append((t, p))
    return found


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _places(phrase: str) -> Column:
    """Starts of a phrase among ``words``; the plain search on ``joined`` spares most rows the walk."""
    parts = phrase.split()
    here = lambda w, i: (w == parts[0]) & F.lit(True) if len(parts) == 1 else _all([w == parts[0], *[F.get("words", i + k) == p for k, p in enumerate(parts) if k]])
    starts = F.filter(F.transform("words", lambda w, i: F.when(here(w, i), i.cast("long"))), lambda i: i.isNotNull())
    return F.when(F.contains("joined", F.lit(f" {phrase} ")), starts).otherwise(F.array().cast("array<bigint>"))


def _all(conditions: list[Column]) -> Column:
    both = conditions[0]
    for c in conditions[1:]:
        both = both & c
    return both


def _candidates(postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Distinct (template, start) that enough postings of the words in ``words`` agree on."""
    empty = F.array().cast("array<struct<t:int,at:int>>")
    if not postings:
        return empty
    table = F.create_map(*[x for w, places in postings.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in places]))])
    rare = list(postings)
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(rare), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    votes = F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(table, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("at")))))
    return F.when(F.exists("words", lambda w: w.isin(rare)), F.array_sort(votes)).otherwise(empty)


def scan(df: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: dict[str, str] | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, the base counts, ``notices`` (label, start, words, share of each notice found), ``labels`` and ``score``."""
    phrases = PHRASES if phrases is None else phrases
    notices = [t.notice.split() for t in templates]
    vocabulary = sorted({w for n in notices for w in n})
    postings = index(templates, rarity(df, vocabulary, text)) if vocabulary else {}
    kept = df.columns if keep is None else keep
    told = df.select(F.struct(*[df[f"`{c}`"] for c in kept]).alias("row"), words(df[f"`{text}`"]).alias("words"))
    base = told.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    base = base.withColumns({**{f"base{k}": _places(p) for k, p in enumerate(phrases)}, "votes": _candidates(postings)}).drop("joined")

    # sorted votes: a start is a candidate if the vote MIN_AGREEING - 1 places on is for the same one, and it is the first of them
    same = lambda v, k: F.coalesce(F.get("votes", k) == v, F.lit(False))
    agreed = F.filter("votes", lambda v, k: same(v, k + (MIN_AGREEING - 1)) & ~same(v, k - 1))
    size = _ints([len(n) for n in notices])
    found = F.transform(
        agreed,
        lambda c: F.struct(
            F.get(_texts(t.label for t in templates), c["t"]).alias("label"),
            c["at"].cast("long").alias("start"),
            F.get(size, c["t"]).cast("long").alias("n"),
            (F.size(F.filter(F.get(_lists(notices), c["t"]), lambda w, j: F.coalesce(F.get("words", c["at"] + j) == w, F.lit(False)))) / F.get(size, c["t"])).alias("share"),
            F.forall(F.get(_lists([t.keys for t in templates]), c["t"]), lambda key: F.contains(_window(c["at"], F.get(size, c["t"])), F.concat(F.lit(" "), key, F.lit(" ")))).alias("whole"),
        ),
    )
    sure = F.filter("found", lambda f: f["whole"] & (f["share"] >= MIN_SHARE))
    starts = F.array_sort(F.flatten(F.array(*[F.col(f"base{k}") for k in range(len(phrases))]))) if phrases else F.array().cast("array<bigint>")
    by_base = F.flatten(F.array(*[F.when(F.size(f"base{k}") > 0, F.array(F.lit(v))).otherwise(F.array().cast("array<string>")) for k, v in enumerate(phrases.values())])) if phrases else F.array().cast("array<string>")
    judged = base.withColumn("found", found if templates else F.array().cast("array<struct<label:string,start:bigint,n:bigint,share:double,whole:boolean>>")).withColumns({"sure": sure, "starts": starts, "by_base": by_base})
    return judged.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.size("starts").cast("long").alias("n_base"),
        F.get("starts", F.lit(0)).alias("first_word"),
        F.get("starts", F.size("starts") - 1).alias("last_word"),
        F.array_sort(F.array_distinct("by_base")).alias("base_labels"),
        F.transform("sure", lambda f: f.dropFields("whole")).alias("notices"),
        F.array_sort(F.array_distinct(F.concat("by_base", F.transform("sure", lambda f: f["label"])))).alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("sure", lambda f: f["share"])), F.lit(0.0))).alias("score"),
    )


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _lists(values) -> Column:
    return F.array(*[_texts(v) for v in values])


def _window(at: Column, n: Column) -> Column:
    """The words about a notice's place, each between blanks."""
    start = F.greatest(at - SLACK, F.lit(0))
    return F.concat(F.lit(" "), F.array_join(F.slice("words", start + 1, F.greatest(at + n + SLACK - start, F.lit(0))), " "), F.lit(" "))
