import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from casewise.llm import licenses as L
from tests.llm.conftest import DOC_SCHEMA


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, lookups=10**6, least=0.5):
    vocabulary = set(L.index_words())
    files = [words(t) for _, t in rows]
    df = Counter(w for f in files for w in set(f) & vocabulary)
    idf = {w: math.log((len(files) + 1) / (n + 0.5)) for w, n in df.items()}
    top = max(idf.values(), default=1.0)
    out = []
    for (i, _), f in zip(rows, files, strict=True):
        rare = sorted(set(f) & vocabulary, key=lambda w: (-idf[w], w))[:lookups]
        agree = defaultdict(set)
        for w, k, at in L.postings(L.TEMPLATES):
            if w in rare:
                for p, x in enumerate(f):
                    if x == w:
                        agree[k, p - at].add(at)
        found, best = set(), 0.0
        for (k, start), places in agree.items():
            label, passage, phrases = L.TEMPLATES[k]
            tw = passage.split()
            if len(places) < 2 or any((at := start + L._find(tw, p.split())) < 0 or f[at:at + len(p.split())] != p.split() for p in phrases):
                continue
            weight = [idf.get(w, top) if len(w) >= 6 else 0.0 for w in tw]
            share = sum(v for j, (w, v) in enumerate(zip(tw, weight, strict=True)) if start + j >= 0 and f[start + j:start + j + 1] == [w]) / sum(weight)
            if share >= least:
                found.add(label)
                best = max(best, share)
        base = [(p, lab) for ph, lab in L.BASE.items() for p in range(len(f)) if f[p:p + len(ph.split())] == ph.split()]
        own = {lab for _, lab in base}
        out.append((str(i), len(f), len(base), min((p for p, _ in base), default=None), max((p for p, _ in base), default=None),
                    ",".join(sorted(own)), ",".join(sorted(own | found)), round(max(best, 0.5 if own else 0), 9)))
    return out


def test_equals_brute_force(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = ["Released under the MIT License.", "the mit-license MIT LICENSE mit licensed", None, "", "mit ist gut", mit, mit.replace("hereby", "not"),
             "This work is licensed under the GNU General Public License, version 3. " * 3, "General public licenses", "ünder the Apache LICENSE, Version 2.0",
             "Licensed under the Apache License, Version 2.0.", "Redistribution and use in source and binary forms, with or without modification",
             "license " * 500 + "creative commons attribution 4 0 International license", "Kelvin mit licenſe", "free software foundation public domain",
             "released released under the mit license " * 200, "the terms of the gnu lesser general public license"]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, "plain words only")] * 20
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC_SCHEMA)
    got = sorted([(str(r[0]), *r[1:7], round(r[7], 9)) for r in L.scan(docs).collect()], key=str)
    assert got == sorted(brute(rows), key=str)
    assert any(r[6] == "gpl,lgpl" for r in got)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "mit license", "x", "y", 2)], DOC_SCHEMA)
    out = L.scan(docs.withColumns({"labels": F.lit(1), "w": F.lit(2), "file": F.lit(3)}))
    assert out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert tuple(out.first())[:7] == (1, 2, 1, 0, 0, "mit", "mit") and L.scan(docs.limit(0)).count() == 0


def test_no_template_is_left_out(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    mpl = "subject to the terms of the Mozilla Public License, v. 2.0"
    prose = "attribution commons compliance documentation foundation hereby obtaining permission redistribution software international "
    texts = [f"{mit}. {bsd}. {mpl}.", prose * 50 + mpl, prose * 50 + "under the terms of the GNU Lesser General Public License",
             " ".join(p for _, p, _ in L.TEMPLATES), bsd + " " + prose, "mozilla public license", "license mit license " * 300 + mit]
    rnd = random.Random(3)
    pieces = [p for _, p, _ in L.TEMPLATES] + prose.split()
    for _ in range(60):
        got = " ".join(rnd.choices(pieces, k=rnd.randint(1, 8))).split()
        texts.append(" ".join(w for w in got if rnd.random() < 0.97))
    rows = list(enumerate(texts)) + [(1000 + i, "public license general subject terms") for i in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC_SCHEMA)
    got = sorted([(str(r[0]), *r[1:7], round(r[7], 9)) for r in L.scan(docs).collect()], key=str)
    assert got == sorted(brute(rows), key=str) != sorted(brute(rows, lookups=6), key=str)
    labels = {r[0]: r[6] for r in got}
    assert labels["0"] == "bsd,mit,mpl" and labels["1"] == "mpl" and labels["2"] == "gpl,lgpl"
    assert set(labels["3"].split(",")) == {t[0] for t in L.TEMPLATES}
