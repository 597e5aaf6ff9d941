"""Licence scans by a positional rare-token index. DataFrame functions only.

Templates (notices, headings, identifiers, whole short licences) give postings: word -> (template, position), for all their words, the
licence words, whose document frequencies are counted over all documents. Each document's own licence words are ranked by inverse
document frequency and the rarest are looked up, TOP of them or SHARE of what it has, no others. A place p of a looked-up word with template position t votes for the relative position p - t of that
template; where at least MEET different words meet, the template's words are compared in place: it counts when its mandatory key phrase stands
at its place and LEAST of its words agree. So a template is found by the rare words that the document shares with it; one whose words are all among the more
frequent ones of the document is not looked up (README: recall). Base phrases are found directly from the places of licence words.

Words are runs of letters a-z, digits and non-ASCII characters after lower-casing A-Z. A document
goes on to the look-up only if it contains a word that every phrase or template needs at least one of; that
test is a plain substring search, and it can only let too many pass.

Defined cases: null text counts as empty: no words, no labels, score 0, null places. Very long texts are one row; their votes are as many as the places of the
looked-up words. Ties in frequency go by word; the best agreement counts, whichever template has it. Repeated rows each
get their own result. An empty table gives no rows. Extra columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.75
TOP, SHARE = 24, (3, 4)  # licence words of a document that are looked up: at least so many, or this share of them
MEET = 2  # looked-up words that must stand at one relative position
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that are in no word once A-Z are lower-cased.
PARTING = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

#: Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Fixed values: (label, template, mandatory key phrase, the word of the key phrase that the pre-test looks for).
TEMPLATES = [
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license", "license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license", "license"),
    ("artistic-2.0", "licensed under the artistic license 2 0", "artistic license", "license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms", "binary"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4", "cc"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc", "cc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa", "cc"),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0", "cc0", "cc"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license", "license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2", "license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3", "license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee", "without"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", "lesser general public license", "license"),
    ("mit", "released under the mit license", "mit license", "license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge", "hereby"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license", "license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "without limitation the rights to use copy", "without"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "except in compliance with the license", "license"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license as published", "license"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "must retain the above copyright notice", "must"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software", "unencumbered"),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007", "affero general public license version 3", "license"),
    ("apache-2.0", "apache license version 2 0 january 2004", "apache license version 2 0", "license"),
    ("bsd", "bsd 2 clause license", "bsd 2 clause", "clause"),
    ("bsd", "bsd 3 clause license", "bsd 3 clause", "clause"),
    ("cc-by-4.0", "creative commons attribution 4 0 international public license", "attribution 4 0 international", "license"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international public license", "attribution sharealike 4 0", "license"),
    ("gpl-2.0", "gnu general public license version 2 june 1991", "general public license version 2 june", "license"),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007", "general public license version 3 29", "license"),
    ("lgpl-3.0", "gnu lesser general public license version 3 29 june 2007", "lesser general public license version 3", "license"),
    ("mit", "the mit license mit copyright", "mit license mit", "license"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license version 2", "license"),
    ("apache-2.0", "spdx license identifier apache 2 0", "license identifier apache 2", "license"),
    ("bsd", "spdx license identifier bsd 3 clause", "license identifier bsd", "license"),
    ("gpl-2.0", "spdx license identifier gpl 2 0", "license identifier gpl 2", "license"),
    ("gpl-3.0", "spdx license identifier gpl 3 0", "license identifier gpl 3", "license"),
    ("isc", "spdx license identifier isc", "license identifier isc", "license"),
    ("mit", "spdx license identifier mit", "license identifier mit", "license"),
    ("mpl-2.0", "spdx license identifier mpl 2 0", "license identifier mpl 2", "license"),
]

VOCABULARY = sorted({w for _, t, *_ in TEMPLATES for w in t.split()} | {w for p, _ in BASE for w in p.split()})
GATE = sorted({g for *_, g in TEMPLATES} | {"cc", "license", "reserved"})


def spaced(text: Column) -> Column:
    """Lower-cased text with a space for every character that parts words."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER + PARTING, LOWER + " " * len(PARTING))


def words(low: Column) -> Column:
    """Its words. A plain split at single spaces is several times as fast as a regular expression."""
    return F.array_remove(F.split(low, " "), "")


def frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Documents, and how many of them have each vocabulary word: at most one row for each of these words."""
    own = docs.select(F.array_intersect(words(spaced(F.col("text"))), F.array(*[F.lit(w) for w in VOCABULARY])).alias("ws"))
    rows = own.select(F.explode(F.concat("ws", F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    n = {r.w: r["count"] for r in rows}
    return n.pop("", 0), n


def postings(word: str) -> list[tuple[int, int]]:
    """(template, position) of a word."""
    return [(k, i) for k, (_, t, *_) in enumerate(TEMPLATES) for i, w in enumerate(t.split()) if w == word]


def _literal(rows: list[tuple], names: tuple[str, ...]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, r, strict=True)]) for r in rows])


def scan(docs: DataFrame, least: float = LEAST, top: int = TOP, share: tuple[int, int] = SHARE, counted: tuple[int, dict[str, int]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document. `counted` takes frequencies that are there already."""
    total, df = counted or frequencies(docs)
    idf = {w: math.log((1 + total) / (1 + df.get(w, 0))) for w in VOCABULARY}
    ranked = sorted(VOCABULARY, key=lambda w: (-idf[w], w))
    templates = F.array(*[F.array(*[F.lit(w) for w in t.split()]) for _, t, _, _ in TEMPLATES])
    keys = []
    for _, t, key, _ in TEMPLATES:
        t, key = t.split(), key.split()
        at = next(i for i in range(len(t)) if t[i : i + len(key)] == key)
        keys.append((at, len(key)))
    key_of = _literal(keys, ("at", "n"))
    names = F.array(*[F.lit(label) for label, *_ in TEMPLATES])

    low = spaced(F.col("text"))
    gate = F.lit(False)
    for w in GATE:
        gate = gate | F.contains("low", F.lit(w))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), low.alias("low"))
    out = out.select("doc_id", words(F.col("low")).alias("ws"), gate.alias("live"))

    # places of vocabulary words, in order
    empty = F.array().cast("array<struct<w:string,p:int>>")
    hits = F.filter(F.transform("ws", lambda w, i: F.struct(w.alias("w"), i.alias("p"))), lambda h: h.w.isin(VOCABULARY))
    out = out.select("doc_id", F.size("ws").cast("long").alias("n_words"), F.when(F.col("live"), F.col("ws")).alias("ws"), F.when(F.col("live"), hits).otherwise(empty).alias("hits"))

    def stands(phrase: list[str]) -> Column:
        """Starts of a phrase: its words follow each other among the hits, place by place."""

        def here(h, k):
            ok = h.w == phrase[0]
            for j, w in enumerate(phrase[1:], 1):
                nxt = F.get("hits", k + j)
                ok = ok & F.coalesce((nxt.w == w) & (nxt.p == h.p + j), F.lit(False))
            return ok

        return F.transform(F.filter("hits", here), lambda h: h.p)

    base = [(stands(p.split()), label) for p, label in BASE]
    out = out.withColumns({f"base{k}": c for k, (c, _) in enumerate(base)})
    places = F.concat(*[F.col(f"base{k}") for k in range(len(base))])
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(base)]))

    # the highest-IDF licence words of the document: the ranked words that it has, in their order, cut off
    own = F.array_intersect(F.array(*[F.lit(w) for w in ranked]), F.transform("hits", lambda h: h.w))
    out = out.withColumn("looked", F.when(F.size("hits") > 0, own).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("looked", F.slice("looked", 1, F.greatest(F.lit(top), F.ceil(F.size("looked") * share[0] / share[1]).cast("int"))))

    # a vote is one number: template, relative position, and which looked-up word it comes from; so equal and meeting ones are told by value
    lists = F.create_map(*[x for w in VOCABULARY for x in (F.lit(w), _literal(postings(w), ("t", "i")) if postings(w) else F.array().cast("array<struct<t:int,i:int>>"))])
    shift = 1 << 20  # starts that lie before the document's
    vote = lambda x, p, k: F.shiftleft(x.t.cast("long"), 44) + F.shiftleft(p.cast("long") - x.i + shift, 8) + k

    def of_word(w: Column, k: Column) -> Column:
        """The votes of all places of a looked-up word."""
        places = F.transform(F.filter("hits", lambda h: h.w == w), lambda h: h.p)
        return F.flatten(F.transform(places, lambda p: F.transform(F.element_at(lists, w), lambda x: vote(x, p, k))))

    votes = F.array_sort(F.array_distinct(F.flatten(F.transform("looked", of_word))))
    out = out.withColumn("sorted", F.when(F.size("looked") >= MEET, votes).otherwise(F.array().cast("array<bigint>")))
    meet = F.filter("sorted", lambda x, i: F.coalesce(F.shiftright(F.get("sorted", i - (MEET - 1)), 8) == F.shiftright(x, 8), F.lit(False)))
    place = F.array_distinct(F.transform(meet, lambda x: F.shiftright(x, 8)))
    out = out.withColumn("votes", F.transform(place, lambda x: F.struct(F.shiftright(x, 36).cast("int").alias("t"), (F.pmod(x, F.lit(1 << 36)) - shift).cast("int").alias("off"))))

    def agreement(v: Column) -> Column:
        """Share of the template's words that stand at their places; 0 without the key phrase."""
        t, key = F.get(templates, v.t), F.get(key_of, v.t)
        same = lambda i: F.coalesce(F.get("ws", F.when(v.off + i >= 0, v.off + i)) == F.get(t, i), F.lit(False))
        need = F.forall(F.sequence(key["at"], key["at"] + key.n - 1), same)
        return F.when(need, F.size(F.filter(F.sequence(F.lit(0), F.size(t) - 1), same)) / F.size(t)).otherwise(F.lit(0.0))

    found = F.filter(F.transform("votes", lambda v: F.struct(F.get(names, v.t).alias("label"), agreement(v).alias("s"))), lambda r: r.s >= least)
    out = out.withColumn("found", F.when(F.size("votes") > 0, found).otherwise(F.array().cast("array<struct<label:string,s:double>>")))
    best = F.array_max(F.transform("found", lambda r: r.s))
    return out.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("found", lambda r: r.label)))), ",").alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """The same as SQL: ranks by document frequency, votes of the TOP words, verification in place; written from the tables above."""
    at = lambda i: f"CASE WHEN i + {i} >= 1 THEN ws[i + {i}] END"
    places = lambda ks: f"list_filter(range(1, len(ws) + 1), lambda i: {' AND '.join(f"({at(j)}) IS NOT DISTINCT FROM '{w}'" for j, w in enumerate(ks))})"
    cols = [f"{places(p.split())} AS b{k}" for k, (p, _) in enumerate(BASE)]
    spots = "list_concat(" * (len(BASE) - 1) + "b0" + "".join(f", b{k})" for k in range(1, len(BASE)))
    base = ", ".join(f"CASE WHEN len(b{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(BASE))
    rows = []
    for k, (_, t, key, _) in enumerate(TEMPLATES):
        t, key = t.split(), key.split()
        first = next(i for i in range(len(t)) if t[i : i + len(key)] == key)
        rows += [f"({k}, {i}, '{w}', {str(first <= i < first + len(key)).lower()})" for i, w in enumerate(t)]
    names = ", ".join(f"({k}, '{label}', {len(t.split())})" for k, (label, t, *_) in enumerate(TEMPLATES))
    base_words = ", ".join(f"('{w}')" for w in sorted({w for p, _ in BASE for w in p.split()}))
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), t AS (SELECT * FROM (VALUES {", ".join(rows)}) v(t, i, word, must)
), n AS (SELECT * FROM (VALUES {names}) v(t, label, size)
), k AS (SELECT word FROM t UNION SELECT word FROM (VALUES {base_words}) v(word)
), h AS (
  SELECT rid, word, p - 1 AS p FROM (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w) q WHERE word IN (SELECT word FROM k)
), f AS (
  SELECT word, count(DISTINCT rid) AS df FROM h GROUP BY word
), o AS (
  SELECT rid, word FROM (SELECT d.rid, d.word, row_number() OVER (PARTITION BY d.rid ORDER BY df, d.word) AS r, count(*) OVER (PARTITION BY d.rid) AS n FROM (SELECT DISTINCT rid, word FROM h) d JOIN f ON d.word = f.word) q WHERE r <= greatest({TOP}, (n * {SHARE[0]} + {SHARE[1] - 1}) // {SHARE[1]})
), v AS (
  SELECT h.rid, t.t, p - t.i AS off FROM h JOIN o ON h.rid = o.rid AND h.word = o.word JOIN t ON t.word = h.word GROUP BY ALL HAVING count(DISTINCT h.word) >= {MEET}
), c AS (
  SELECT v.rid, v.t, off, count(*) FILTER (WHERE (CASE WHEN off + i >= 0 THEN ws[off + i + 1] END) IS NOT DISTINCT FROM word) AS same, bool_and((CASE WHEN off + i >= 0 THEN ws[off + i + 1] END) IS NOT DISTINCT FROM word) FILTER (WHERE must) AS holds
  FROM v JOIN w ON v.rid = w.rid JOIN t ON t.t = v.t GROUP BY ALL
), l AS (
  SELECT rid, list(DISTINCT label) AS labels, max(same / size) AS best FROM c JOIN n ON c.t = n.t WHERE holds AND same / size >= {LEAST} GROUP BY rid
), g AS (
  SELECT *, {spots} AS spots, [{base}] AS base FROM (SELECT w.*, l.labels, best, {", ".join(cols)} FROM w LEFT JOIN l ON w.rid = l.rid) q
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base, CAST(list_min(spots) - 1 AS BIGINT) AS first_word, CAST(list_max(spots) - 1 AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels, coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ','), '') AS labels,
  CAST(CASE WHEN len(spots) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS DOUBLE) AS score
FROM g
"""
