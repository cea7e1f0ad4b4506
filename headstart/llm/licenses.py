"""License scans by diagonal voting (operator 13).

Templates are short phrases that name a license, one-line grants, and notices or whole licenses.

1. *Join.* Every document's rolling hashes of ``PHRASE_K`` and of ``TEMPLATE_K`` words, one row each,
   meet the templates' positions in a Spark join (the template side is broadcast: its size is
   that of ``TEMPLATES``, whatever the corpus).
2. *Vote.* A match of place ``i`` with template place ``t`` votes for the diagonal ``i - t``; votes
   are aggregated by document, template and diagonal.
3. *Merge.* Diagonals of a template within ``SLACK`` of each other (words put in or left out)
   become one span; a phrase's diagonals stay apart. A span with too small a share of the
   template's k-grams goes.
4. *Verify.* The spans left meet their texts again: a phrase or a grant must stand there word
   by word, of a longer template ``MIN_SHARE`` of the words in order (longest common subsequence).

Only matches are shuffled before the spans are known, and only texts with a span after that.
The score is the largest share of a verified template; a bare phrase counts ``PHRASE_SCORE``.

Edge cases: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null, empty and wordless
texts have no words, labels or places and score 0; texts of any length are scanned whole; rows
are told apart by id and SHA-256 of the text, so rows that repeat both, or have a null id,
get a row each; overlapping places all count; an empty table gives an empty result; of the
input only ``doc_id`` and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, stage
from .near_dedup import _Words

PHRASE_K = 2
TEMPLATE_K = 4
#: How far apart diagonals of a template may lie to become one span.
SLACK = 8
#: Share of a template's k-grams that a span must have matched, and of its words in order.
MIN_VOTES, MIN_SHARE = 0.25, 0.75
#: A template with fewer words must stand in the text word by word.
WHOLE_BELOW = 20
PHRASE_SCORE = 0.5
#: Keys of texts with spans that are broadcast at most (8 bytes each), to filter texts where they are read.
BROADCAST_KEYS = 1_000_000
WORD = r"[^\x00-/:-@\[-`{-\x7F]+"

# Phrases, grants and license texts with their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
     notice shall be included in all copies or substantial portions of the Software."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
     with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
     applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
     WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
     Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
     later version."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
     and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
     conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
     publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
     purpose, commercial or non-commercial, and by any means."""),
]

_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_words = _Words()
_FACTORS = np.random.default_rng(13).integers(0, 1 << 64, TEMPLATE_K, np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").lower().translate(_LETTERS).split() if text else []


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A hash of the ``k`` words from each place on where there are as many."""
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    m = max(0, len(w) - k + 1)
    h = np.full(m, k, np.uint64)
    for i in range(k):
        h = (h + w[i:i + m]) * _FACTORS[i]
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _all_templates() -> list[tuple[str, list[bytes], int]]:
    """(label, words, k) of every template; phrases come first."""
    return [(label, words_of(t), PHRASE_K) for label, t in PHRASES] + [(label, words_of(t), TEMPLATE_K) for label, t in TEMPLATES]


def template_positions(spark: SparkSession) -> DataFrame:
    """``h, template, t, grams, slack``: a row for each place of each template."""
    found = []
    for n, (_, words, k) in enumerate(_all_templates()):
        h = gram_hashes(words, k).tolist()
        found += [(x, n, t, len(h), SLACK if k == TEMPLATE_K else 0) for t, x in enumerate(h)]
    return spark.createDataFrame(found, "h long, template int, t int, grams int, slack int")


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


KEY = ["doc_id", "text_key"]


def gram_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, i, h``: every rolling hash of every document, of two words and of four."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                c = b.slice(at, 64)
                out = []
                for text in c.column("text").to_pylist():
                    words = words_of(text)
                    both = np.zeros((2, len(words)), np.int64)
                    for row, k in zip(both, (PHRASE_K, TEMPLATE_K)):
                        h = gram_hashes(words, k)
                        row[:len(h)] = h
                    out.append(both.reshape(-1))
                size = np.cumsum([0, *map(len, out)]).astype(np.int32)
                yield pa.record_batch({"doc_id": c.column("doc_id"), "text_key": c.column("text_key"),
                                       "h": pa.ListArray.from_arrays(pa.array(size), pa.array(np.concatenate(out)))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rolled = map_arrow(docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text"), hashes,
                       f"doc_id {kind}, text_key binary, h array<long>")
    n = (F.size("h") / 2).cast("int").alias("n")
    return rolled.select(*KEY, n, F.posexplode("h").alias("i", "h")).select(*KEY, F.expr("i % n").alias("i"), "h")


def voted_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, template, lo, hi, votes``: merged diagonals with enough votes."""
    hits = gram_rows(docs).join(F.broadcast(template_positions(docs.sparkSession)), "h")
    votes = hits.groupBy(*KEY, "template", (F.col("i") - F.col("t")).alias("diagonal")) \
        .agg(F.collect_set("t").alias("ts"), F.max("grams").alias("grams"), F.max("slack").alias("slack"))
    w = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(w) > F.col("slack")).cast("int")
    runs = votes.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("span", F.sum("apart").over(w))
    merged = runs.groupBy(*KEY, "template", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("votes"), F.min("diagonal").alias("lo"),
        F.max("diagonal").alias("hi"), F.max("grams").alias("grams"), F.max("slack").alias("slack"))
    enough = F.when(F.col("slack") == 0, F.col("votes") == F.col("grams")).otherwise(F.col("votes") >= MIN_VOTES * F.col("grams"))
    return merged.filter(enough).select(*KEY, "template", "lo", "hi", "votes")


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence."""
    ids = {w: n for n, w in enumerate(dict.fromkeys(a + b))}
    y = np.array([ids[w] for w in b], np.int64)
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == ids[x])))
    return int(row[-1])


def verified(words: list[bytes], spans: list[dict], templates: list[tuple[str, list[bytes], int]]) -> list[tuple[int, int, float]]:
    """(template, start, share) of the spans that hold their template."""
    out = []
    for s in spans:
        _, want, k = templates[s["template"]]
        if k == PHRASE_K:
            if words[s["lo"]:s["lo"] + len(want)] == want:
                out.append((s["template"], s["lo"], PHRASE_SCORE))
            continue
        start = max(0, s["lo"])
        share = common_words(want, words[start:max(0, s["hi"]) + len(want)]) / len(want)
        if share >= (MIN_SHARE if len(want) >= WHOLE_BELOW else 1):
            out.append((s["template"], start, share))
    return out


_FOUND = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,start:bigint,share:double>>")
_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words``, the base phrases' places and labels, all ``labels``, ``score`` and verified
    ``spans`` (label, first word, share of the template) of every document."""
    spark = docs.sparkSession
    spans = stage(voted_spans(docs).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("template", "lo", "hi"))).alias("voted")),
                  "license-spans")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    few = spans.count() <= BROADCAST_KEYS
    short = spans.select(F.xxhash64("text_key").alias("short")).distinct()
    likely = keyed.withColumn("short", F.xxhash64("text_key")).join(F.broadcast(short), "short", "left_semi").drop("short") if few else keyed
    a, b = likely.alias("a"), spans.alias("b")
    on = F.col("a.text_key").eqNullSafe(F.col("b.text_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    with_spans = a.join(b, on).select("a.doc_id", "a.text", "b.voted")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = _all_templates()
        for batch in batches:
            out = []
            for text, voted in zip(batch.column("text").to_pylist(), batch.column("voted").to_pylist()):
                words = words_of(text)
                got = verified(words, voted, templates)
                base = [(t, at) for t, at, _ in got if t < len(PHRASES)]
                starts = [at for _, at in base]
                joined = lambda ts: ",".join(sorted({templates[t][0] for t in ts}))
                out.append({"n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None),
                            "last_word": max(starts, default=None), "base_labels": joined(t for t, _ in base),
                            "labels": joined(t for t, *_ in got), "score": max((x for *_, x in got), default=0.0),
                            "spans": [{"label": templates[t][0], "start": at, "share": x} for t, at, x in got]})
            schema = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])
            t = pa.RecordBatch.from_pylist(out, schema)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *t.columns], ["doc_id", *t.schema.names])

    found = map_arrow(with_spans, verify, f"doc_id {kind}, {_FOUND}")
    c = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                    F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")).alias("a")
    none = c.join(b, on, "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"),
        F.lit([]).cast("array<struct<label:string,start:bigint,share:double>>").alias("spans"))
    return found.unionByName(none)
