import re

from tessel.llm import licenses as L

SCHEMA = "doc_id long, text string, n_words string, labels string"
TEXTS = [
    None, "", "...", "mit license", "MIT License.", "the MIT, License! mit\nlicense mit the license",
    "Licensed under CC BY-NC 4.0 and CC BY 4.0", "\x7fx", "é mit license", "mİt license", "mKit license",
    "This work is licensed under the GNU General Public License, version 3.", "license mit", "general public",
    "gnu lesser general public license apache license, version 2.0 (Licensed under the Apache License, Version 2.0)",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "permission was hereby granted free of charge to any person", "version 3 " * 500 + "mit license",
    "General public General Public License " * 300, "cc by nc 4 0", "nc cc by",
]


def brute(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    def places(phrase):
        p = phrase.split()
        return [i for i in range(len(w)) if w[i : i + len(p)] == p]

    found = [(s, k) for k, p in L.BASE.items() for s in places(p)]
    starts, base = [s for s, _ in found], sorted({k for _, k in found})
    own = {k for k, (_, key) in L.TEMPLATES.items() if places(key)}
    return (len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(base)), own, base


def test_matches_brute_force(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", "y"), (None, "apache license", None, None)]
    got = L.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *map(str, brute(t)[0])) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in got) == want
    texts = dict((i, t) for i, t, *_ in rows)
    for r in got:
        _, own, base = brute(texts[r.doc_id])
        assert r.labels == ",".join(sorted(own | set(base)))  # no key phrase is missed, none invented
        assert (r.score > 0) == bool(own or base) and 0 <= r.score <= 1


def test_native_plan_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = L.scan(df)
    assert out.count() == 0
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


def test_a_file_quoting_every_licence_keeps_every_label(spark):
    whole = [t for t, _ in L.TEMPLATES.values()]
    texts = ["\n\n".join(whole), "\n".join(whole[::-1]) + " x " + " ".join(whole), whole[10] + " mozilla public license"]
    texts += [" / ".join(L.TEMPLATES[k][0] for k in ("bsd", "isc", "mit-text", "mpl"))]
    texts += ["a public license"] * 3 + ["mozilla"]  # document frequencies that rank public and license last
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        _, own, base = brute(text)
        assert got[i].labels == ",".join(sorted(own | set(base)))
    assert set(L.TEMPLATES) <= set(got[0].labels.split(","))
    for name, (_, key) in L.TEMPLATES.items():  # every place of every key phrase
        n = len(re.findall(rf"(?<!\w){key}(?!\w)", texts[1].replace("\n", " ")))
        assert sum(m.label == name for m in got[1].matches) == n


def test_key_phrases_of_one_word_or_common_words_only(spark):
    templates = {"one": ("the quux licence", "quux"), "common": ("free for any use", "free for any use")}
    df = spark.createDataFrame([(0, "a quux, the quux licence"), (1, "free for any use"), (2, "free any")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, len(r.matches)) for r in L.scan(df, templates, {"x": "no such"}).collect()}
    assert got == {0: ("one", 2), 1: ("common", 1), 2: ("", 0)}
