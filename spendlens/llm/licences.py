"""Licence scans with a positional index of rare licence words.

A template is a run of words with a key phrase that must stand in it unchanged; of the other words a share may differ.
Document frequencies of all key-phrase words are counted over the whole table, and the index posts every template
under the rarest word of its key phrase, with that word's place. A file's licence words are looked up there, rarest
first by construction; a posting at place p of a word at place i proposes the template at i - p, the other words are
intersected at their relative places, and the key phrase is verified. Since the posted word belongs to the key phrase,
every match is found, whatever the frequencies are. All of it is DataFrame functions on one row per document; the index has
one entry per template and reaches the rows as a scalar subquery.

Words are runs of ASCII digits, letters and characters from U+0080 on, with A-Z in lower case.

Cases: null and empty texts have no words and no matches, empty labels, null places and score 0. Rows without doc_id and
repeated rows come back each on its own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    words: str
    key: str  # a run of the words
    least: float = 1.0  # share of words that must agree
    base: bool = False


TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", base=True),
    Template("apache", "apache license", "apache license", base=True),
    Template("cc-by", "cc by", "cc by", base=True),
    Template("mit", "mit license", "mit license", base=True),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-4.0", "cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    Template("creative-commons", "creative commons attribution", "creative commons attribution"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license version 2 0"),
    Template("epl", "eclipse public license", "eclipse public license"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "granted free of charge", 0.7,
    ),
    Template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that",
        "source and binary forms", 0.7,
    ),
    Template(
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "distribute this software for any purpose", 0.7,
    ),
    Template(
        "unlicense-text",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software", 0.7,
    ),
)


def _key_places(template: Template) -> list[int]:
    words, key = template.words.split(), template.key.split()
    start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    return list(range(start, start + len(key)))


def words_of(text: str = "text") -> Column:
    return F.array_remove(F.split(common.ascii_folded(text), SEPARATORS), "")


def index(rows: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row: all templates, each with the rarest word of its key phrase over ``rows`` (column words) and its place."""
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    seen = rows.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("word"))
    frequency = seen.groupBy("word").agg(F.count("*").alias("n"))
    entries = F.array(*(
        F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.least).alias("least"),
            F.array(*map(F.lit, t.words.split())).alias("words"), F.array(*map(F.lit, _key_places(t))).alias("key"),
        )
        for t in templates
    ))
    table = rows.sparkSession.range(1).select(F.inline(entries))
    keyed = table.select("*", F.explode("key").alias("place")).withColumn("word", F.get("words", F.col("place")))
    rare = keyed.join(frequency, "word", "left").groupBy("label").agg(
        F.min_by(F.struct("label", "base", "least", "words", "key", "place", "word"), F.struct(F.coalesce("n", F.lit(0)), "place")).alias("entry")
    )
    return rare.agg(F.sort_array(F.collect_list("entry")).alias("entries"))


MATCHES = """
flatten(transform(
  filter(sequence(0, size(words)), i -> get(words, i) IN ({vocabulary})),
  i -> transform(
    filter(postings, p -> p.word = words[i] AND i >= p.place AND i - p.place + size(p.words) <= size(words)
      AND forall(p.key, k -> words[i - p.place + k] = p.words[k])),
    p -> named_struct('label', p.label, 'base', p.base, 'least', p.least, 'start', i - p.place, 'size', size(p.words),
      'agree', size(filter(sequence(0, size(p.words) - 1), k -> words[i - p.place + k] = p.words[k]))))))
"""


def matches(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and the matches of each row: label, base, start, size, agree (words that are the template's)."""
    rows = docs.select("doc_id", words_of().alias("words"))
    vocabulary = ", ".join(sorted({f"'{w}'" for t in templates for w in t.key.split()}))
    looked_up = rows.withColumn("postings", index(rows, templates).scalar()).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.expr(MATCHES.format(vocabulary=vocabulary)).alias("proposed")
    )
    found = F.filter("proposed", lambda m: m["agree"] >= m["least"] * m["size"])
    return looked_up.select("doc_id", "n_words", found.alias("matches"))


def _joined_labels(array: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(array, lambda m: m["label"]))), ",")


def report(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    found = matches(docs, templates).withColumn("base", F.filter("matches", lambda m: m["base"]))
    starts = F.transform("base", lambda m: m["start"].cast("long"))
    score = F.array_max(F.transform("matches", lambda m: m["agree"] / (m["size"] + 1)))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined_labels(F.col("base")).alias("base_labels"), _joined_labels(F.col("matches")).alias("labels"),
        F.round(F.coalesce(score, F.lit(0.0)), 6).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return report(common.read(spark, sf_dir, "documents"))


def sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """Every template tried at every place."""
    columns, labels = [], []
    for n, t in enumerate(templates):
        words, key = t.words.split(), _key_places(t)
        same = [f"w[s+{k}] = '{word}'" for k, word in enumerate(words)]
        all_of = " AND ".join(same[k] for k in key)
        share = " + ".join(f"coalesce(CAST({c} AS INT), 0)" for c in same)
        columns.append(f"""list_filter(range(1, len(w) - {len(words)} + 2), lambda s: {all_of}
      AND ({share}) >= {t.least} * {len(words)}) AS m{n},
    list_max(list_transform(m{n}, lambda s: ({share}) / ({len(words)} + 1))) AS q{n}""")
        labels.append(f"CASE WHEN len(m{n}) > 0 THEN '{t.label}' END")
    base = [n for n, t in enumerate(templates) if t.base]
    starts = f"flatten([{', '.join(f'm{n}' for n in base)}])"

    def joined(items: list[str]) -> str:
        return f"array_to_string(list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)), ',')"

    return rf"""
WITH words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), found AS (SELECT doc_id, w, {", ".join(columns)} FROM words)
SELECT doc_id, len(w) AS n_words, len({starts}) AS n_base, list_min({starts}) - 1 AS first_word, list_max({starts}) - 1 AS last_word,
  {joined([labels[n] for n in base])} AS base_labels, {joined(labels)} AS labels,
  round(coalesce(greatest({", ".join(f"q{n}" for n in range(len(templates)))}), 0), 6) AS score
FROM found
"""
