"""Licence scans by a positional rare-token index, in DataFrame functions only.

Base labels come from places where a phrase's words stand one after the other.
The method's own labels come from templates of licence notices: the templates'
words are counted over all documents; each template is indexed by the ``RAREST``
words of its mandatory key phrase with the highest IDF, whatever their share of
the documents.  Every indexed word of a document is looked up in the postings
(template, position); lookups that agree in the relative position (document
position minus template position) for all of a template's indexed words point to
a place, where the key phrase must stand word for word.  So no place of a key
phrase is missed.

Everything about a document is computed in its own row; only the document
frequencies (one row per template word) are gathered.

Defined cases: a null text counts as empty: no words, no labels, score 0;
repeated rows are scanned each; null doc_ids are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.llm.common import read

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Licence notices as (label, notice, mandatory key phrase).
TEMPLATES = (
    ("gpl-3.0", "licensed under the gnu general public license version 3", "public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc0", "the author has waived all copyright and related or neighboring rights", "waived all copyright"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted", "distribute this software for any purpose"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
)
#: Indexed places of each key phrase.
RAREST = 2

_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Words before A-Z are put in lower case.
WORD = f"[^{_GAP}]+"
_phrase = {p: f"[{_GAP}]+".join(p.split()) for p in PHRASES}
#: (?i) folds A-Z only.
ANY_PHRASE = f"(?i)(?<![^{_GAP}])(?:{'|'.join(_phrase.values())})(?![^{_GAP}])"
_words = [t[1].split() for t in TEMPLATES]
_keys = [t[2].split() for t in TEMPLATES]
_key_at = [next(i for i in range(len(w)) if w[i:i + len(k)] == k) for w, k in zip(_words, _keys)]
VOCABULARY = sorted({x for w in _words for x in w})


def _quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "\\'") + "'" for x in items)


def _licence_words(vocabulary) -> str:
    """SQL test of a word x; words with other than ASCII characters never pass."""
    return f"(lower(x) IN ({_quoted(vocabulary)}) AND octet_length(x) = char_length(x))"


def frequencies(texts: DataFrame) -> dict[str, int]:
    """Documents that hold each template word, over all documents."""
    words = F.expr(f"array_distinct(transform(filter(regexp_extract_all(text, r'{WORD}', 0), x -> {_licence_words(VOCABULARY)}), "
                   f"x -> lower(x)))")
    df = texts.select(F.explode(words).alias("w")).groupBy("w").count().collect()
    return {r[0]: r[1] for r in df}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    and places: (label, first word, share of the notice's words found)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = frequencies(texts)
    # of each template: the places of its key phrase's rarest words
    chosen = [sorted(sorted(range(at, at + len(k)), key=lambda q: (df.get(w[q], 0), q))[:RAREST])
              for w, k, at in zip(_words, _keys, _key_at)]
    rare = sorted({w[q] for w, places in zip(_words, chosen) for q in places}, key=lambda w: (df.get(w, 0), w))
    rank = {w: i for i, w in enumerate(rare)}
    postings = [[(t, q) for t, places in enumerate(chosen) for q in places if _words[t][q] == r] for r in rare]
    rank_map = "map(" + ", ".join(f"{_quoted([w])}, {i}" for w, i in rank.items()) + ")"
    post = "array(" + ", ".join("array(" + ", ".join(f"named_struct('t', {t}, 'q', {q})" for t, q in p) + ")" for p in postings) + ")"
    notices = "array(" + ", ".join(
        f"named_struct('label', {_quoted([TEMPLATES[t][0]])}, 'words', array({_quoted(_words[t])}), 'at', {_key_at[t]}, "
        f"'size', {len(_keys[t])}, 'phrase', {_quoted([TEMPLATES[t][2]])})" for t in range(len(TEMPLATES))) + ")"

    rows = texts.select("doc_id", "text", F.expr(f"regexp_extract_all(text, r'{WORD}', 0)").alias("words"),
                        F.expr(f"regexp_extract_all(text, r'{ANY_PHRASE}', 0)").alias("found"))
    base = "transform(found, x -> lower(regexp_replace(x, r'[%s]+', ' ')))" % _GAP
    label = "CASE " + " ".join(f"WHEN p = {_quoted([p])} THEN {_quoted([v])}" for p, v in PHRASES.items()) + " END"
    rows = rows.select(
        "doc_id", "words", F.expr("size(words)").cast("long").alias("n_words"), F.expr("size(found)").cast("long").alias("n_base"),
        F.expr(f"array_sort(array_distinct(transform({base}, p -> {label})))").alias("base"),
        F.expr(f"CASE WHEN size(found) > 0 THEN split(text, r'{ANY_PHRASE}', -1) END").alias("between"),
        F.expr(f"CASE WHEN size(found) > 0 THEN regexp_count(element_at(found, size(found)), r'{WORD}') END").alias("last_size"),
        F.expr(f"size(filter(words, x -> {_licence_words(rare)}))").alias("n_rare"))
    rows = rows.select(
        "doc_id", "words", "n_words", "n_base", "base",
        F.expr(f"CASE WHEN n_base > 0 THEN regexp_count(between[0], r'{WORD}') END").cast("long").alias("first_word"),
        F.expr(f"CASE WHEN n_base > 0 THEN n_words - last_size - regexp_count(element_at(between, size(between)), r'{WORD}') END")
        .cast("long").alias("last_word"),
        F.expr(f"CASE WHEN n_rare >= {RAREST} THEN filter(transform(words, (x, i) -> named_struct('r', "
               f"IF({_licence_words(rare)}, {rank_map}[lower(x)], -1), 'i', i)), h -> h.r >= 0) "
               f"ELSE cast(array() as array<struct<r:int,i:int>>) END").alias("hits"))
    rows = rows.withColumn("aligned", F.expr(
        f"array_sort(flatten(transform(hits, h -> "
        f"transform(element_at({post}, h.r + 1), p -> named_struct('t', p.t, 'at', h.i - p.q)))))"))
    rows = rows.withColumn("spots", F.expr(
        f"filter(aligned, (a, i) -> i >= {RAREST - 1} AND get(aligned, i - {RAREST - 1}) = a)"))
    # the key phrase has to stand at its place; the notice's other words count for the score
    rows = rows.withColumn("places", F.expr(
        f"transform(filter(transform(spots, s -> named_struct('at', s.at, 'n', element_at({notices}, s.t + 1))), "
        f"c -> c.at + c.n.at >= 0 AND lower(array_join(slice(words, c.at + c.n.at + 1, c.n.size), ' ')) = c.n.phrase), "
        f"c -> named_struct('label', c.n.label, 'first_word', c.at, 'share', "
        f"aggregate(transform(c.n.words, (x, i) -> IF(lower(get(words, c.at + i)) = x, 1, 0)), 0, (a, b) -> a + coalesce(b, 0)) "
        f"/ cast(size(c.n.words) as double)))"))
    own = F.transform("places", lambda p: p["label"])
    best = F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", own))), ",").alias("labels"),
        F.greatest(best, F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"), "places")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).drop("places")
