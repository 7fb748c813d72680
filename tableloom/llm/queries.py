"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import align, bitslice, bpe, chat, hilbert, licences, negatives, packing, partenum, pieces, quality, suffixes, urls
from tableloom.plans.scratch import materialize
from tableloom.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with SQL when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, directory: fn(Tables(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# words, shingles and their sets per document, then links found over shared shingles
OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x
)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM s JOIN r ON s.doc_id = r.x GROUP BY s.doc_id, s.sh
"""


@query("op4_ngram_jaccard_join", OP4_SQL)
def op4(t: Tables) -> DataFrame:
    return partenum.near_duplicates(t.documents).select("doc_id", "n_shingles", "component_id")


@query("op8_suffix_array_dedup")
def op8(t: Tables) -> DataFrame:
    return suffixes.remove_repeats(t.documents)


@query("op3_quality_classifier")
def op3(t: Tables) -> DataFrame:
    stats = materialize(quality.statistics_table(t.documents))
    return quality.score_table(stats, quality.fit(stats, t.labels))


@query("op10_best_fit_packing")
def op10(t: Tables) -> DataFrame:
    return packing.pack(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


OP2_SQL = """
WITH u AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM u a JOIN u b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


@query("op2_bit_sliced_top_k", OP2_SQL)
def op2(t: Tables) -> DataFrame:
    return bitslice.top_k(t.embeddings, F.col("vec_id") % 20 == 0, 20)


@query("op9_hilbert_neighbours")
def op9(t: Tables) -> DataFrame:
    return hilbert.nearest(t.embeddings, F.col("vec_id") % 100 == 0, 10)


# host rules and a small labelled table, fixed values
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCKED_URLS = """
https://casino-win.example.com/en/1/ http://www.casino-win.example.org/de/play?x=1 https://bigcasino.example.com/slots
https://m.ads-track.example.com/en/8092/ https://ads.example.org/banner http://track.example.com/click?id=7
https://pixel-track.example.org/i.gif https://adserver.example.com/es/show https://free-win.example.com/prize
https://win-big.example.org/jackpot https://poker-casino.example.com/ http://bet-now.example.org/odds
https://xxx-video.example.com/free https://cheap-pills.example.org/buy http://pills-online.example.com/order
https://loan-fast.example.org/apply https://spam-links.example.com/out https://click-ads.example.com/go
https://popup-ads.example.org/en/55.html http://casino.example.com/fr/bonus https://lottery-win.example.org/es/7
https://doubleads.example.com/track https://ads-track.example.org/de/3#top https://m.casino-win.example.com/es/9.html
""".split()
ALLOWED_URLS = """
https://blog.ththnt.example.com/fr/38225/ http://m.ththan.example.org/en/36685/ https://therst.example.com/es/15997?page=2
https://www.library.example.org/en/catalog https://news.example.com/en/2020/05/story.html http://docs.example.org/guide/
https://shop.example.com/de/item/41 https://university.example.org/courses https://m.tiontion.example.com/en/14506
https://blog.tionble.example.com/es/9793#top https://forum.example.org/thread/88 https://recipes.example.com/fr/soup
https://museum.example.org/en/art http://weather.example.com/today https://code.example.org/project/readme
https://www.ththes.example.com/en/1346.html https://ththon.example.com/es/4024?ref=x https://m.thther.example.org/de/5151
https://travel.example.com/es/madrid https://history.example.org/en/rome https://blog.ththre.example.org/en/31
https://science.example.com/de/physik https://music.example.org/fr/jazz https://ththhe.example.com/en/10945
""".split()


@query("op1_url_filter")
def op1(t: Tables) -> DataFrame:
    known = [F.struct(F.lit(u).alias("url"), F.lit(b).alias("blocked")) for b, urls_ in ((1, BLOCKED_URLS), (0, ALLOWED_URLS)) for u in urls_]
    labelled = t.spark.range(1).select(F.inline(F.array(*known)))
    judged = urls.judge(t.pages.select("page_id", "url"), URL_RULES, labelled)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_ESC = r"regexp_replace(replace(coalesce({0}, ''), '\', '\\'), '([<\[])(/?s>|image>|audio>|document>|/?ROLE\]|/?INST\])', '\1\\\2', 'g')"
OP5_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), f AS (
  SELECT *, '<s>[ROLE]' || {_ESC.format('role')} || '[/ROLE]' || CASE WHEN role = 'user' THEN '[INST] ' ELSE '' END
    || {_ESC.format('text')} || CASE WHEN role = 'user' THEN ' [/INST]' ELSE '' END || '</s>' AS formatted FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, formatted)) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


@query("op5_chat_formatting", OP5_SQL)
def op5(t: Tables) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = t.spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = t.conversations.select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.conversation_digests(chat.format_turns(rows))


@query("op6_bpe_encoding")
def op6(t: Tables) -> DataFrame:
    encoded = bpe.encode(t.documents, public_tokenizers.path("word_bpe_49k.json"))
    sha = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return encoded.select("doc_id", "n_tokens", *sha)


# notices by which documents name their licence, fixed values
LICENCES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Released under the 3-Clause BSD License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "BSD-2-Clause": "Released under the 2-Clause BSD License.",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "ISC": "Released under the ISC License.",
    "EUPL-1.2": "Licensed under the European Union Public Licence, version 1.2.",
    "Unlicense": "Released into the public domain under the Unlicense.",
}
# licences that a text names by two bare words, fixed values
BARE_NAMES = {"MIT": "MIT License", "ISC": "ISC License"}


def licence_templates() -> list[tuple[str, str, str]]:
    """(licence, kind, text) of all notices, bare names, identifier lines, headers and full texts."""
    notices = [(name, "notice", text) for name, text in LICENCES.items()]
    names = [(name, "name", text) for name, text in BARE_NAMES.items()]
    identifiers = [(name, "identifier", f"SPDX-License-Identifier: {name}") for name in LICENCES]
    return notices + names + identifiers + licences.licence_texts()


@query("op7_licence_scan")
def op7(t: Tables) -> DataFrame:
    return licences.find(t.documents, licence_templates())


@query("op11_sentencepiece_encoding")
def op11(t: Tables) -> DataFrame:
    encoded = pieces.encode(t.documents, public_tokenizers.path("piece_bpe_32k.model"))
    decoded = F.sha2(F.encode("decoded", "UTF-8"), 256)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"))


@query("op12_tokenizer_alignment")
def op12(t: Tables) -> DataFrame:
    return align.alignment(t.documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


OP13_SQL = """
WITH u AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM u a JOIN u b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(t: Tables) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(t.embeddings, label, F.col("vec_id") % 100 == 0, 5, 5)
