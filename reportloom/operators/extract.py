"""Structured extraction: prompts, pluggable clients, answers to typed columns, validation."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import doc_id_parts, json_array, json_object

_EVIDENCE = "quote_summary:string,quote:string,source_section:string"
#: The typed form of an extraction.
SCHEMA = (
    f"struct<business_outputs:array<struct<name:string,type:string,description:string,revenue_amount:double,revenue_ratio:double,gross_margin:double,production_or_sales_info:string,downstream_application:string,{_EVIDENCE}>>,"
    f"upstream_inputs:array<struct<name:string,type:string,description:string,importance:string,amount:double,ratio:double,risk:string,{_EVIDENCE}>>,"
    f"counterparties:array<struct<name:string,role:string,is_anonymous:boolean,relation_description:string,related_product_or_service:string,amount:double,ratio:double,rank:int,{_EVIDENCE}>>,"
    f"governance:struct<management:array<struct<name:string,position:string,description:string,{_EVIDENCE}>>,shareholders:array<struct<name:string,type:string,shareholding_ratio:double,shares:bigint,is_controlling_shareholder:boolean,{_EVIDENCE}>>,actual_controller:array<struct<name:string,type:string,control_description:string,{_EVIDENCE}>>>,"
    f"subsidiaries:array<struct<name:string,relationship:string,ownership_ratio:double,main_business:string,registered_location:string,financial_summary:string,{_EVIDENCE}>>>"
)
#: A client takes a prompt and returns an answer's text.
Client = Callable[[str], str]


def prompt(template: str, **parts: Column) -> Column:
    """``template`` with {names} replaced by columns."""
    out = F.lit(template)
    for name, c in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out


def ask(rows: DataFrame, client: Callable[[], Client], attempts: int = 3, wait: float = 2.0) -> DataFrame:
    """rows with answer, attempt and error instead of prompt: one client a partition, tries with doubling waits, an error row after the last.

    A column session goes to the client as its second argument. As many requests run at a time as there are tasks.
    """
    keys = [f for f in rows.schema.fields if f.name not in ("prompt", "session")]
    asked = [c for c in ("prompt", "session") if c in rows.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()

        def answer(*question) -> tuple:
            for k in range(1, attempts + 1):
                try:
                    return call(*question), k, None
                except Exception as e:  # noqa: BLE001  the answer row says what failed
                    if k == attempts:
                        return None, k, str(e)
                    time.sleep(wait**k)

        for b in batches:
            out = [answer(*question) for question in zip(*(b[c] for c in asked))]
            b = b[[f.name for f in keys]].copy()
            for k, name in enumerate(("answer", "attempt", "error")):
                b[name] = [x[k] for x in out]
            yield b

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return rows.mapInPandas(run, f"{schema}, answer string, attempt int, error string")


def message(template: str, doc_id: Column, **more: Column) -> Column:
    """A document's message: ``template`` with {doc_id}, {code}, {name}, {year} and what else is given."""
    parts = doc_id_parts(doc_id)
    return prompt(template, doc_id=doc_id, code=parts["code"], name=parts["name"], year=parts["year"], **more)


def region_prompts(docs: DataFrame, regions: DataFrame, template: str, sections: dict[str, str]) -> DataFrame:
    """(doc_id, start, end, prompt) for regions (doc_id, start, end): {start}, {end}, {sections}, one in a line with its words, and the region's {text}."""
    names = "\n".join(f"- {name}: {words}" for name, words in sections.items())
    both = regions.select("doc_id", "start", "end").join(docs.select("doc_id", "text"), "doc_id")
    text = F.substring(F.col("text"), F.col("start") + 1, F.col("end") - F.col("start"))
    return both.select("doc_id", "start", "end", prompt(template, start=F.col("start"), end=F.col("end"), sections=F.lit(names), text=text).alias("prompt"))


def region_boundaries(docs: DataFrame, answers: DataFrame, confidence: float = 0.9) -> DataFrame:
    """(doc_id, pos, raw_title, canonical, confidence) of answers (doc_id, start, answer) with a JSON array of titles.

    A title is where its text first stands from the region's start on, or else at the start. Answers without an array and
    items without both names give no rows.
    """
    items = F.from_json(json_array(F.col("answer")), "array<struct<raw_title:string,canonical_name:string>>")
    each = answers.select("doc_id", "start", F.explode(items).alias("x")).select("doc_id", "start", "x.raw_title", F.col("x.canonical_name").alias("canonical"))
    each = each.filter("raw_title IS NOT NULL AND canonical IS NOT NULL").join(docs.select("doc_id", "text"), "doc_id")
    at = F.when(F.col("raw_title") != "", F.expr("locate(raw_title, text, start + 1)")).otherwise(0)
    pos = F.when(at > 0, at - 1).otherwise(F.col("start")).cast("int")
    return each.select("doc_id", pos.alias("pos"), "raw_title", "canonical", F.lit(confidence).alias("confidence"))


#: The JSON schema that binds a model's answer about contents.
CONTENTS_FORM = {
    "type": "object", "required": ["sections"],
    "properties": {"sections": {"type": "array", "items": {
        "type": "object", "required": ["order", "raw_title"],
        "properties": {"order": {"type": "integer"}, "raw_title": {"type": "string"}, "canonical_name": {"type": ["string", "null"]}},
    }}},
}


def contents_answers(answers: DataFrame) -> DataFrame:
    """(doc_id, order, raw_title, canonical) of answers in CONTENTS_FORM; sections without a canonical name and answers of another form give no rows."""
    form = "struct<sections:array<struct<order:int,raw_title:string,canonical_name:string>>>"
    sections = F.from_json("answer", form)["sections"]
    sound = F.forall(sections, lambda x: x["order"].isNotNull() & x["raw_title"].isNotNull())
    each = answers.select("doc_id", F.explode(F.when(sound, sections)).alias("x")).filter("x.canonical_name <> ''")
    return each.select("doc_id", "x.order", "x.raw_title", F.col("x.canonical_name").alias("canonical"))


def parse(answers: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """answers (doc_id, answer) with the typed ``data`` (null when there is no JSON object)."""
    return answers.withColumn("json", json_object(F.col("answer"))).withColumn("data", F.from_json("json", schema))


def facts(parsed: DataFrame) -> DataFrame:
    """(doc_id, category, name, ratio, quote_summary, quote): every extracted fact as a row."""
    kinds = (("business_outputs", "revenue_ratio"), ("upstream_inputs", "ratio"), ("counterparties", "ratio"), ("governance.shareholders", "shareholding_ratio"), ("subsidiaries", "ownership_ratio"))

    def part(kind: str, ratio: str) -> Column:
        items = F.coalesce(F.col(f"data.{kind}"), F.array().cast(parsed.select(f"data.{kind}").schema[0].dataType))
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("category"), x["name"].alias("name"), x[ratio].alias("ratio"), x["quote_summary"].alias("quote_summary"), x["quote"].alias("quote")))

    parts = [part(*k) for k in kinds]
    return parsed.select("doc_id", F.explode(F.concat(*parts)).alias("f")).select("doc_id", "f.*")


def validate(rows: DataFrame) -> DataFrame:
    """Facts with the rules that they break: a ratio is a fraction, evidence is there, a quote has 80 to 250 characters, a summary 30 at most, no fact twice."""
    again = F.count("*").over(Window.partitionBy("doc_id", "category", "name"))
    rules = F.array(
        F.when(~F.coalesce(F.col("ratio").between(0, 1), F.lit(True)), "ratio"),
        F.when(F.coalesce(F.col("quote"), F.lit("")) == "", "evidence"),
        F.when(~F.coalesce(F.length("quote").between(80, 250), F.lit(True)), "quote_length"),
        F.when(F.length("quote_summary") > 30, "summary_length"),
        F.when(F.col("copies") > 1, "duplicate"),
    )
    return rows.withColumn("copies", again).withColumn("broken", F.array_compact(rules)).drop("copies")


def response_text(responses: DataFrame) -> DataFrame:
    """(doc_id, text) of gateway responses (doc_id, response JSON): the texts of output items, whatever their content's shape, in order."""
    v = responses.withColumn("v", F.try_parse_json("response"))
    direct = F.try_variant_get("v", "$.output_text", "string")
    items = F.expr("try_variant_get(v, '$.output', 'array<variant>')")
    strings = F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$.content", "string"), F.try_variant_get(x, "$.content.text", "string"), F.array_join(F.transform(F.coalesce(F.try_variant_get(x, "$.content", "array<variant>"), F.array().cast("array<variant>")), lambda y: F.coalesce(F.try_variant_get(y, "$.text", "string"), F.try_variant_get(y, "$", "string"), F.lit(""))), "")))
    return v.select("doc_id", F.coalesce(F.array_join(strings, ""), direct, F.lit("")).alias("text"))


def sse_text(events: DataFrame) -> DataFrame:
    """(response_id, text, state) of event lines (response_id, seq, line): deltas joined in order; failed beats completed beats open; bad lines are skipped."""
    data = F.regexp_extract("line", r"^data:\s*(.*)$", 1)
    e = events.withColumn("d", data).withColumn("type", F.get_json_object("d", "$.type")).withColumn("delta", F.get_json_object("d", "$.delta"))
    got = e.groupBy("response_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == "response.output_text.delta", F.struct("seq", "delta")))), lambda x: x["delta"]), "").alias("text"),
        F.max(F.when(F.col("type") == "response.failed", 3).when((F.col("type") == "response.completed") | (F.col("d") == "[DONE]"), 2).otherwise(1)).alias("s"),
    )
    return got.select("response_id", "text", F.when(F.col("s") == 3, "failed").when(F.col("s") == 2, "completed").otherwise("open").alias("state"))
