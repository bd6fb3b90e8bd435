"""Licence scans by a positional rare-token index, in DataFrame operations only.

Templates are short standard passages of licences.  Their distinctive words (of at least
``INDEX_LETTERS`` letters) form a positional index: word -> (template, place).  A file is
scanned so:

1. A file takes part if it holds an index word; of each such word the table gives the
   inverse document frequency over all files.
2. Of every template whose key phrases' index words all stand in the file, the words that the
   file holds are looked up from the highest IDF down.  A start that is to be verified must
   carry ``least_share`` of the template's weight, so looking up ends once the words left weigh
   too little to do without two of those looked up: no start is missed, whatever other
   templates or words the file holds.
3. The postings looked up are intersected by relative position: a start of the template in the
   file (before its first word, if the file begins inside the passage) stays if two agree on it.
4. A start is verified: the template's mandatory key phrases must stand at their
   places word for word, and the places that agree must carry at least ``least_share`` of the
   template's IDF weight.

Base labels come from three phrases found anywhere, independent of the index.

score: the largest verified share; at least 0.5 if a base label was found; else 0.

Defined edge cases: null counts as empty; files without words have null first and last
place and empty labels; repeated rows and null ids are kept; an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import stored

#: label, passage, its mandatory key phrases (fixed values: standard licence wordings).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ["permission is hereby granted", "free of charge"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
     ["permission notice shall be included in all copies or substantial portions"]),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software under the mit no attribution license",
     ["mit no attribution"]),
    ("x11", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale", ["x consortium"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["with or without fee is hereby granted"]),
    ("0bsd", "zero clause bsd permission to use copy modify and distribute this software for any purpose", ["zero clause bsd"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache", "you may not use this file except in compliance with the license", ["except in compliance with the license"]),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
     ["agreed to in writing software distributed under the license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("lgpl", "under the terms of the gnu library general public license", ["gnu library general public license"]),
    ("gfdl", "under the terms of the gnu free documentation license with no invariant sections", ["gnu free documentation license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that",
     ["redistribution and use in source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
     ["must retain the above copyright notice"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived",
     ["names of its contributors may be used to endorse or promote"]),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledgement",
     ["advertising materials mentioning features"]),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("epl", "made available under the terms of the eclipse public license v 2 0", ["eclipse public license"]),
    ("edl", "made available under the terms of the eclipse distribution license v 1 0", ["eclipse distribution license"]),
    ("cpl", "made available under the terms of the common public license v 1 0", ["common public license"]),
    ("ipl", "provided under the terms of the ibm public license", ["ibm public license"]),
    ("cddl", "subject to the terms of the common development and distribution license", ["common development and distribution license"]),
    ("eupl", "licensed under the european union public licence", ["european union public licence"]),
    ("osl", "licensed under the open software license version 3 0", ["open software license"]),
    ("afl", "licensed under the academic free license version 3 0", ["academic free license"]),
    ("artistic", "you may use it under the terms of the artistic license", ["artistic license"]),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
     ["altered source versions must be plainly marked"]),
    ("boost", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("psf", "this software is under the python software foundation license", ["python software foundation license"]),
    ("php", "this source file is subject to version 3 01 of the php license", ["php license"]),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", ["developed by the openssl project"]),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted",
     ["without a written agreement is hereby granted"]),
    ("ms-pl", "this source code is subject to the microsoft public license", ["microsoft public license"]),
    ("ms-rl", "this source code is subject to the microsoft reciprocal license", ["microsoft reciprocal license"]),
    ("ncsa", "released under the university of illinois ncsa open source license", ["illinois ncsa open source license"]),
    ("upl", "licensed under the universal permissive license v 1 0", ["universal permissive license"]),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", ["sil open font license"]),
    ("odbl", "this database is made available under the open database license", ["open database license"]),
    ("wtfpl", "do what the fuck you want to public license", ["you want to public license"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     ["waived all copyright and related or neighboring rights"]),
    ("cc0", "dedicated to the public domain by the creative commons zero universal waiver", ["creative commons zero"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
]
#: phrase -> label (fixed values of the base rule).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
INDEX_LETTERS = 6
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: SQL: (template, start) of every start on which two of the postings looked up agree.
_STARTS = """
flatten(transform(
  filter(sequence(0, {last}), k -> size(array_except(tn[k], held)) = 0),
  k -> transform(array(filter(tp[k], p -> array_contains(held, p.word))), own ->
    transform(array(slice(own, 1, aggregate(own,
        named_struct('rest', aggregate(own, 0D, (a, p) -> a + p.weight), 'n', 0),
        (a, p) -> if(a.rest + own[0].weight >= {least} * aggregate(ti[k], 0D, (b, v) -> b + v),
                     named_struct('rest', a.rest - p.weight, 'n', a.n + 1), a),
        a -> a.n))), looked ->
      transform(array(array_sort(flatten(transform(looked, p ->
          transform(filter(occ, o -> o.word = p.word), o -> o.place - p.at))))), s ->
        transform(array_distinct(filter(transform(s, (x, i) -> if(i > 0 and x = s[greatest(i - 1, 0)], x, null)), x -> x is not null)),
                  x -> named_struct('template', k, 'start', x)))[0])[0])[0]))
"""


def index_words(templates=None) -> list[str]:
    """The distinctive words of all templates, and of the base phrases."""
    words = {w for _, passage, _ in templates or TEMPLATES for w in passage.split()} | {w for p in BASE for w in p.split()}
    return sorted(w for w in words if len(w) >= INDEX_LETTERS)


def postings(templates) -> list[tuple[str, int, int]]:
    """(word, template, place) of every index word."""
    return [(w, k, i) for k, (_, passage, _) in enumerate(templates) for i, w in enumerate(passage.split()) if len(w) >= INDEX_LETTERS]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(f"({_WORD})"), F.lit(1))


def _places(phrase: str) -> str:
    """SQL: all places in the word array ``w`` where the phrase starts."""
    parts = phrase.split()
    same = " and ".join(f"get(w, i + {k}) = '{p}'" for k, p in enumerate(parts) if k)
    return f"filter(transform(w, (x, i) -> if(x = '{parts[0]}' and {same}, i, null)), i -> i is not null)"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, least_share: float = 0.5) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    templates = templates or TEMPLATES
    vocabulary = index_words(templates)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    files = docs.select(F.col(f"`{id_col}`").alias("id"), _words(text).alias("w")).withColumn("occ", F.expr(
        f"filter(transform(w, (x, i) -> if(x in ({listed}), named_struct('word', x, 'place', i), null)), o -> o is not null)"))
    files = stored(files.select("id", F.size("w").cast("long").alias("n_words"), F.when(F.size("occ") > 0, F.col("w")).alias("w"), "occ",
                                F.array_distinct("occ.word").alias("held")), "license-files")
    total = files.count()
    per_word = files.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    idf = per_word.select("word", F.log((F.lit(total) + 1) / (F.col("df") + 0.5)).alias("idf"))
    weights = {r["word"]: r["idf"] for r in idf.collect()}  # at most the vocabulary

    # one row with the templates' words, key phrases as (place, length) and weighted places
    unseen = F.lit(float(max(weights.values(), default=1.0)))
    def arr(values, kind):
        return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    passages = [p.split() for _, p, _ in templates]
    keys = [[(_find(p, k.split()), len(k.split())) for k in phrases] for p, (_, _, phrases) in zip(passages, templates, strict=True)]
    t_words = F.array(*[arr(p, "string") for p in passages])
    t_keys = F.array(*[F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for a, n in k]) for k in keys])
    t_idf = F.array(*[F.array(*[F.lit(float(weights[w])) if w in weights else (unseen if len(w) >= INDEX_LETTERS else F.lit(0.0)) for w in p]) for p in passages])
    needs = [sorted({w for p in phrases for w in p.split() if len(w) >= INDEX_LETTERS}) for _, _, phrases in templates]
    by_idf = [sorted(((w, at, float(weights[w])) for w, _, at in postings([t]) if w in weights), key=lambda p: (-p[2], p[1])) for t in templates]
    t_needs = F.array(*[arr(n, "string") for n in needs])
    t_posts = F.array(*[F.array(*[F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"), F.lit(v).alias("weight")) for w, at, v in p]).cast(
        "array<struct<word: string, at: int, weight: double>>") for p in by_idf])
    checked = files.withColumns({"tw": t_words, "tk": t_keys, "ti": t_idf, "tn": t_needs, "tp": t_posts})
    starts = _STARTS.format(last=len(templates) - 1, least=f"{least_share * (1 - 1e-9)}D")
    checked = checked.withColumn("starts", F.when(F.size("occ") > 0, F.expr(starts)))
    share = ("aggregate(zip_with(tw[c.template], sequence(0, size(tw[c.template]) - 1), (x, i) -> "
             "if(get(w, c.start + i) = x, ti[c.template][i], 0D)), 0D, (a, x) -> a + x) / aggregate(ti[c.template], 0D, (a, x) -> a + x)")
    whole = "forall(tk[c.template], k -> c.start + k.a >= 0 and slice(w, greatest(c.start + k.a, 0) + 1, k.n) = slice(tw[c.template], k.a + 1, k.n))"
    checked = checked.withColumn("found", F.expr(
        f"filter(transform(filter(starts, c -> {whole}), c -> named_struct('template', c.template, 'share', {share})), x -> x.share >= {least_share})"))
    names = arr([t[0] for t in templates], "string")
    out = checked.select("id", "w", "n_words", F.transform("found.template", lambda t: F.get(names, t)).alias("more"),
                         F.array_max("found.share").alias("share"))
    base = {label: F.expr(_places(p)) for p, label in BASE.items()}
    out = out.withColumns({f"at_{label}": F.coalesce(places, F.expr("cast(array() as array<int>)")) for label, places in base.items()})
    every = F.concat(*[F.col(f"at_{label}") for label in base])
    labels = F.array_compact(F.array(*[F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label in base]))
    out = out.withColumns({"every": every, "own": labels, "more": F.coalesce("more", F.expr("cast(array() as array<string>)"))})
    return out.select(
        F.col("id").alias(id_col), "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("own")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("own", "more"))).alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("own") > 0, 0.5).otherwise(0.0)).alias("score"))


def _find(words: list[str], phrase: list[str]) -> int:
    """Where the phrase stands in the passage; a template must hold its key phrases."""
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
