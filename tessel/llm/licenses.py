"""Licence scan with a positional rare-token index, in DataFrame functions only.

Templates are the licences' own notices with one mandatory key phrase each.  The words of
each key phrase are ranked by inverse document frequency measured over all documents, and
the index maps the ``RARE`` highest of every template, and no others, to their postings
``(template, position)``.  The index words that a file holds are looked up; their postings
are turned into placements (file position minus template position), placements on which a
template's rare words agree survive the intersection, and the template counts only where
its key phrase stands word for word: everywhere it does, since its rarest words are
mandatory words, however many other licences the file quotes.  The score is the
idf-weighted share of the template's words found at their places, so a passing mention
scores below a whole notice; a base phrase is its own template and scores 1.

All of it happens inside the row: the text is split once, and only files that hold
a licence word evaluate the rest.  One aggregate over all documents (a row for
each licence word) gives the document frequencies; nothing else is shuffled.

Defined cases: a null text counts as empty and has no words, places or labels and
score 0; repeated rows are scanned each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: label -> phrase whose places are counted
BASE = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

_FREE = "free software you can redistribute it and or modify it under the terms of the gnu"
_FSF = "as published by the free software foundation"

#: label -> (template words, mandatory key phrase inside them); fixed values: wording of the licences' notices
TEMPLATES = {
    "agpl": (f"this program is {_FREE} affero general public license {_FSF}", "affero general public license"),
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
        "apache license version 2",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms",
    ),
    "cc-by-4.0": ("this work is licensed under cc by 4 0", "cc by 4 0"),
    "cc-by-nc-4.0": ("this work is licensed under cc by nc 4 0", "cc by nc 4 0"),
    "cc-by-sa-4.0": ("this work is licensed under cc by sa 4 0", "cc by sa 4 0"),
    "gpl-2.0": (f"this program is {_FREE} general public license version 2 {_FSF}", "general public license version 2"),
    "gpl-3.0": (f"this program is {_FREE} general public license version 3 {_FSF}", "general public license version 3"),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and or distribute",
    ),
    "lgpl": (f"this library is {_FREE} lesser general public license {_FSF}", "lesser general public license"),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "permission is hereby granted free of charge",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        "mozilla public license",
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software",
        "unencumbered software released into the public domain",
    ),
}

RARE = 2  # highest-idf words of a key phrase whose postings are looked up
#: words too common in any prose to tell a licence: never index terms
COMMON = frozenset("a and any are by for free in is of or out this the to under use with without".split())
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of a text column, A-Z lower-cased; an empty word first or last where separators stand there."""
    # the Kelvin sign is the only other character whose lower case is an ASCII letter
    plain = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.split(F.lower(plain), _SEPARATORS)


def _vocabulary(templates: dict[str, tuple[str, str]], base: dict[str, str]) -> list[str]:
    found = {w for t, _ in templates.values() for w in t.split()} - COMMON
    found |= {w for _, key in templates.values() for w in _index_words(key)}
    return sorted(found | {w for p in base.values() for w in p.split()})


def _index_words(key: str) -> set[str]:
    """The words of a key phrase that may be looked up: common ones only where it has no other."""
    return set(key.split()) - COMMON or set(key.split())


def _key_at(whole: list[str], key: list[str]) -> int:
    return next(i for i in range(len(whole)) if whole[i : i + len(key)] == key)


def _strings(items: list[str]) -> Column:
    return F.array(*map(F.lit, items)) if items else F.array().cast("array<string>")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and documents holding each word of ``vocabulary``; one row for each word returns."""
    hits = docs.select(F.explode_outer(F.array_intersect(words_of("text"), _strings(vocabulary))).alias("w"))
    counted = hits.groupBy("w").agg(F.count("*").alias("n")).collect()
    n = docs.count()
    return n, {r["w"]: r["n"] for r in counted if r["w"] is not None}


def _stands(arr: Column, start: Column, words: list[str]) -> Column:
    """The words stand consecutively at ``start`` of ``arr``; false outside."""
    out = F.lit(True)
    for i, w in enumerate(words):
        out = out & F.coalesce(F.get(arr, start + F.lit(i)) == w, F.lit(False))
    return out


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, str]] | None = None,
    base: dict[str, str] | None = None,
    rare: int = RARE,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches``.

    ``matches`` has every verified place: label, first word, words, score of the place.
    """
    templates = TEMPLATES if templates is None else templates
    base = BASE if base is None else base
    vocabulary = _vocabulary(templates, base)
    n_docs, df = document_frequencies(docs, vocabulary)
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1.0 for w in vocabulary}
    names = sorted(templates)
    index: dict[str, list[tuple[int, int]]] = {}  # postings of the words looked up
    lone = []  # templates of which a place has a single posting
    for t, name in enumerate(names):
        whole, key = templates[name][0].split(), templates[name][1].split()
        at = _key_at(whole, key)
        looked = sorted(_index_words(templates[name][1]), key=lambda w: (-idf[w], w))[: max(1, rare)]
        places_of = [(w, at + i) for i, w in enumerate(key) if w in looked]
        for w, i in places_of:
            index.setdefault(w, []).append((t, i))
        if len(places_of) == 1:
            lone.append(t)

    arr, lead = F.col("_arr"), F.col("_lead")
    rows = docs.select("doc_id", words_of("text").alias("_arr"))
    ends = (F.element_at(arr, -1) == "").cast("int")
    rows = rows.select(
        "doc_id",
        "_arr",
        (F.get(arr, F.lit(0)) == "").cast("int").alias("_lead"),
        F.array_intersect(arr, _strings(sorted({*index, *(p.split()[0] for p in base.values())}))).alias("_held"),
        F.greatest(F.size(arr) - (F.get(arr, F.lit(0)) == "").cast("int") - ends, F.lit(0)).cast("long").alias("n_words"),
    )
    located = F.filter(
        F.transform(arr, lambda w, i: F.struct(i.alias("p"), w.alias("w"))),
        lambda h: F.array_contains(F.col("_held"), h["w"]),
    )
    none = F.array().cast("array<struct<p: int, w: string>>")
    rows = rows.select(
        "doc_id", "_arr", "_lead", "n_words",
        F.when(F.size("_held") > 0, located).otherwise(none).alias("_hits"),
        F.array_intersect(_strings(sorted(index)), F.col("_held")).alias("_rare"),
    )

    def places(phrase: str) -> Column:
        w = phrase.split()
        starts = F.transform(F.filter(F.col("_hits"), lambda h: h["w"] == w[0]), lambda h: h["p"])
        return F.filter(starts, lambda s: _stands(arr, s, w))

    postings = F.create_map(
        *(
            x
            for w in sorted(index)
            for x in (F.lit(w), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in index[w])))
        )
    )
    rare_hits = F.filter(F.col("_hits"), lambda h: F.array_contains(F.col("_rare"), h["w"]))
    placed = F.flatten(
        F.transform(
            rare_hits,
            lambda h: F.transform(
                F.element_at(postings, h["w"]), lambda q: F.struct(q["t"].alias("t"), (h["p"] - q["at"]).alias("s"))
            ),
        )
    )
    rows = rows.select(
        "*",
        *(places(p).alias(f"_base_{k}") for k, p in base.items()),
        F.when(F.size("_rare") > 0, F.array_sort(placed))
        .otherwise(F.array().cast("array<struct<t: int, s: int>>"))
        .alias("_placed"),
    )
    # intersection by relative position: a placement that two rare words give stands twice in a row
    twice = lambda x, i: F.coalesce(F.get(F.col("_placed"), i - 1) == x, F.lit(False))
    agreed = F.array_distinct(F.filter(F.col("_placed"), lambda x, i: x["t"].isin(lone) | twice(x, i) if lone else twice(x, i)))

    def verified(x: Column) -> Column:
        out = F.lit(False)
        for t, name in enumerate(names):
            whole, key = (s.split() for s in templates[name])
            at = _key_at(whole, key)
            out = F.when(x["t"] == t, _stands(arr, x["s"] + F.lit(at), key)).otherwise(out)
        return out

    wholes = F.array(*(_strings(templates[n][0].split()) for n in names))
    weights = [[idf[w] if w not in COMMON else 0.1 for w in templates[n][0].split()] for n in names]
    gains = F.array(*(F.array(*map(F.lit, w)) for w in weights))
    totals = F.array(*(F.lit(float(sum(w))) for w in weights))

    def share(x: Column) -> Column:
        got = F.aggregate(
            F.transform(F.get(wholes, x["t"]), lambda w, i: F.when(F.get(arr, x["s"] + i) == w, F.get(F.get(gains, x["t"]), i))),
            F.lit(0.0),
            lambda total, g: total + F.coalesce(g, F.lit(0.0)),
        )
        return F.least(got / F.get(totals, x["t"]), F.lit(1.0))

    def match(label: Column, start: Column, size: Column, score: Column) -> Column:
        return F.struct(
            label.alias("label"), (start - lead).cast("long").alias("start"), size.alias("n_words"), score.alias("score")
        )

    sizes = F.array(*(F.lit(len(templates[n][0].split())) for n in names))
    of_templates = F.transform(
        F.filter(agreed, verified),
        lambda x: match(F.get(_strings(names), x["t"]), x["s"], F.get(sizes, x["t"]), share(x)),
    )

    def of_base(label: str) -> Column:
        size = F.lit(len(base[label].split()))
        return F.transform(F.col(f"_base_{label}"), lambda s: match(F.lit(label), s, size, F.lit(1.0)))

    rows = rows.select(
        "doc_id",
        "n_words",
        F.concat(*map(of_base, base)).alias("_base"),
        F.when(F.size("_placed") > 0, of_templates).otherwise(F.slice(of_templates, 1, 0)).alias("_found"),
    )
    labels = F.concat(F.transform("_base", lambda m: m["label"]), F.transform("_found", lambda m: m["label"]))
    everything = F.concat(F.col("_base"), F.col("_found"))
    starts = F.transform("_base", lambda m: m["start"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_base", lambda m: m["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform(everything, lambda m: m["score"])), F.lit(0.0)).alias("score"),
        everything.alias("matches"),
    )


def oracle_sql() -> str:
    """The scan of ``documents`` as DuckDB SQL: every phrase by plain search at every word, no index."""
    weighted = sorted({w for t, _ in TEMPLATES.values() for w in t.split()} - COMMON)
    words = lambda s: "[" + ", ".join(f"'{w}'" for w in s.split()) + "]"
    idf = {w: f"v[{weighted.index(w) + 1}]" for w in weighted}

    def places(phrase: str) -> str:
        n = len(phrase.split())
        return (
            f"CASE WHEN list_has_all(a, {words(phrase)}) THEN list_filter(range(len(a)), "
            f"lambda i: a[i + 1] = '{phrase.split()[0]}' AND a[i + 1 : i + {n}] = {words(phrase)}) ELSE [] END"
        )

    found, shares = [], []
    for k, (name, (whole, key)) in enumerate(sorted(TEMPLATES.items())):
        w, at = whole.split(), whole.split(key)[0].count(" ")
        weight = [idf[x] if x not in COMMON else "0.1::DOUBLE" for x in w]
        got = " + ".join(
            f"(CASE WHEN s + {j} >= 0 AND a[s + {j + 1}] = '{x}' THEN {g} ELSE 0 END)" for j, (x, g) in enumerate(zip(w, weight))
        )
        found.append(f"list_transform({places(key)}, lambda i: i - {at}) AS t{k}")
        shares.append(f"list_max(list_transform(t{k}, lambda s: least(({got}) / ({' + '.join(weight)}), 1.0)))")
    base = [f"{places(p)} AS b{k}" for k, p in enumerate(BASE.values())]
    all_base = "list_concat(" * (len(BASE) - 1) + "b0" + "".join(f", b{k})" for k in range(1, len(BASE)))
    base_label = [f"(CASE WHEN len(b{k}) > 0 THEN ['{n}'] ELSE [] END)" for k, n in enumerate(BASE)]
    own_label = [f"(CASE WHEN len(t{k}) > 0 THEN ['{n}'] ELSE [] END)" for k, n in enumerate(sorted(TEMPLATES))]
    joined = lambda parts: f"array_to_string(list_sort(list_distinct({' || '.join(parts)})), ',')"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        f"WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents), "
        "d AS (SELECT count(*) AS n, ["
        + ", ".join(f"count(*) FILTER (WHERE list_contains(a, '{x}'))" for x in weighted)
        + "] AS df FROM w), f AS (SELECT list_transform(df, lambda x: ln((n + 1) / (x + 1)) + 1) AS v FROM d), "
        f"p AS (SELECT *, {', '.join(base + found)} FROM w, f) "
        f"SELECT doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len({all_base}) AS BIGINT) AS n_base, "
        f"CAST(list_min({all_base}) AS BIGINT) AS first_word, CAST(list_max({all_base}) AS BIGINT) AS last_word, "
        f"{joined(base_label)} AS base_labels, {joined(base_label + own_label)} AS labels, "
        f"round(coalesce(greatest(CASE WHEN len({all_base}) > 0 THEN 1.0::DOUBLE END, {', '.join(shares)}), 0.0), 6) AS score "
        "FROM p"
    )
