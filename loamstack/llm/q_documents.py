"""Queries over documents: problems 7, 8 and 9."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstack.config import cut, spread
from loamstack.llm.contamination import find_leaks
from loamstack.llm.lookalike import EMOJI_RANGES, same_look_classes, same_look_pairs, tables, visual_column
from loamstack.llm.packing import pack, summary, token_count, violations
from loamstack.sources.tables import table

QUERIES: dict = {}


def form_sql(text: str) -> tuple[str, str]:
    """The one form of a text in SQL, and the table that it needs: each character by the mapping's own table, marks composed; what belongs to an emoji is set apart first."""
    t, e = tables()[0], EMOJI_RANGES
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    m = f"MAP([{', '.join(quote(chr(o)) for o in t)}], [{', '.join(map(quote, t.values()))}])"
    x = f"regexp_replace(nfc_normalize({text}), '([{e}0-9#*])\ufe0f', '\\1\ue000', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, '([{e}][\ue000\U0001f3fb-\U0001f3ff]*)\u200d([{e}])', '\\1\ue001\\2', 'g')"
    return f"nfc_normalize(array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: coalesce(look.m[c], c)), ''))", f"look AS (SELECT {m} AS m)"


ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _documents(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _sizes(spark, d):
    return _documents(spark, d).select("doc_id", token_count(spark, F.col("text")).alias("tokens"))


def _packed(spark, d):
    return pack(_sizes(spark, d), table(spark, d, "pack_specs"))


@query()
def p7_packed(spark, d):
    """Which text, or piece of one, lies in which container of each kind."""
    return _packed(spark, d)


@query()
def p7_fill(spark, d):
    """Containers used and how full they are, by kind."""
    return summary(_packed(spark, d), table(spark, d, "pack_specs"))


@query("SELECT spec_name, (SELECT count(*) FROM documents WHERE text <> '') AS texts, 0 AS over_capacity, 0 AS cut_needlessly, 0 AS wrong_total FROM pack_specs")
def p7_rules(spark, d):
    """Texts placed in each kind of container, and the breaches of the packing's rules."""
    sizes = cut(_sizes(spark, d))
    return violations(pack(sizes, table(spark, d, "pack_specs")), sizes, table(spark, d, "pack_specs"))


def _leaks(spark, d, edited: bool):
    return find_leaks(_documents(spark, d), table(spark, d, "eval_items"), edited=edited)


_FORM, _LOOK = form_sql("text")
_LEAK_SQL = (
    f"WITH {_LOOK}, d AS (SELECT doc_id, regexp_extract_all(lower({_FORM}), '[\\pL\\pN]+') AS w FROM documents, look WHERE text IS NOT NULL), i AS (SELECT item_id, regexp_extract_all(lower({form_sql('passage')[0]}), '[\\pL\\pN]+') AS w FROM eval_items, look WHERE passage IS NOT NULL), "
    "dw AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM d), iw AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM i) "
    "SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (g)"
)


@query(_LEAK_SQL)
def p8_found(spark, d):
    """Documents with at least 13 consecutive words of an item."""
    return _leaks(spark, d, False).select("doc_id", "item_id")


@query()
def p8_items(spark, d):
    """Test items with the number of documents that give them away, whole, in part or edited."""
    return _leaks(spark, d, True).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("longest_run").alias("longest_run"), F.max("score").alias("score"))


_FORMS_SQL = f"WITH {_LOOK}, d AS (SELECT doc_id, text, {_FORM} AS form FROM documents, look WHERE text IS NOT NULL) "


@query(_FORMS_SQL + "SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM d a JOIN d b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text")
def p9_found(spark, d):
    """Pairs of documents that read the same but are stored differently."""
    return same_look_pairs(_documents(spark, d)).select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


@query(_FORMS_SQL + "SELECT sha256(text) AS raw, min(doc_id) AS first_id, count(*) AS rows FROM d GROUP BY form, text QUALIFY count(*) OVER (PARTITION BY form) > 1")
def p9_classes(spark, d):
    """Stored texts whose form has several, each with its first document and number of copies."""
    return same_look_classes(_documents(spark, d)).drop("form")


@query()
def p9_forms(spark, d):
    """Every document in its one form."""
    return _documents(spark, d).select("doc_id", visual_column(F.col("text")).alias("text"))
