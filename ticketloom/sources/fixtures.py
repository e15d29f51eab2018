"""Test inputs derived from the driver's ``documents`` table (FIXTURES.md).

Every fixture is a projection of ``documents`` (one output row per input
row, no shuffle), so it grows with the table and keeps its partitioning.
The DuckDB oracle builds the same rows with the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed_values import OUT_OF_DOMAIN_ERROR, TICKET_FIELDS
from ticketloom.functions.jsonx import quote
from ticketloom.sources.tables import read_table


def _pick(i: Column, mod: int, values: list) -> Column:
    """values[i % mod] (null entries stay null)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(i, F.lit(mod)) + 1).cast("int"))


def _obj(*members: Column) -> Column:
    """'{' + members joined by ', ' (null members left out) + '}'."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def _str_member(key: str, v: Column) -> Column:
    return F.concat(F.lit(f'"{key}": "'), v, F.lit('"'))


# Fixture rule values (FIXTURES.md section 2).
_TYPES = ["Complaint", " complaints", "COMPLAINING", "compla intimation", "Inquiry",
          "enquiray ", "assistance", "Request for Assistance", "refund", "inquiry"]
_DESCRIPTIONS = ["Needs LOAN help", "mortgage on my account", "account locked", "something else"]
_SEVERITY_MEMBERS = ['"Severity": "low"', '"Severity": " Medium"', '"Severity": "HIGH"',
                     '"Severity": "critical"', '"Severity": "urgent"', '"Severity": null', None]
_COMM_MEMBERS = ['"Preferred Communication": "Email"', '"Preferred Communication": "phone "',
                 '"Preferred Communication": "Not Specified"', '"Preferred Communication": "chat"',
                 '"Preferred Communication": "in-person"', None]


# values of other JSON types than strings
TYPED_TICKET = ('{"Ticket Type": "inquiry", "Title": 7, "Description": {"a":1}, "Severity": "low", '
                '"Department Impacted": true, "Service Impacted": ["x",2]}')


def ticket_output(i: Column) -> Column:
    """The ``output`` JSON text of raw ticket ``i``."""
    full = _obj(
        _str_member("Ticket Type", _pick(i, 10, _TYPES)),
        _str_member("Title", F.concat(F.lit("Ticket "), i.cast("string"))),
        _str_member("Description", _pick(i, 4, _DESCRIPTIONS)),
        _pick(i, 7, _SEVERITY_MEMBERS),
        _str_member("Department Impacted", F.concat(F.lit("Dept "), F.pmod(i, F.lit(13)).cast("string"))),
        _str_member("Service Impacted", F.concat(F.lit("Service "), F.pmod(i, F.lit(3)).cast("string"))),
        _pick(i, 6, _COMM_MEMBERS),
        F.when(F.pmod(i, F.lit(250)) == 6, F.lit('"Assistance Request": "loan"')),
    )
    return (F.when(F.pmod(i, F.lit(97)) == 0, F.lit('{"Ticket Type": "complaint"'))
            .when(F.pmod(i, F.lit(89)) == 0, F.lit("[1, 2]"))
            .when(F.pmod(i, F.lit(83)) == 0, F.lit(None).cast("string"))
            .when(F.pmod(i, F.lit(79)) == 0, F.lit('{"Ticket Type": 5, "Severity": "low"}'))
            .when(F.pmod(i, F.lit(73)) == 0, F.lit(TYPED_TICKET))
            .otherwise(full))


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_index BIGINT, input STRING, output STRING``."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select(F.col("doc_id").alias("row_index"), F.col("text").alias("input"),
                    ticket_output(F.col("doc_id")).alias("output"))


_EVAL_TYPES = ["complaint", "inquiry", "assistance"]
_EVAL_SEVERITIES = ["low", "medium", "high", "critical"]
OOD_JSON = '{"error": "' + OUT_OF_DOMAIN_ERROR + '"}'


def true_json(i: Column) -> Column:
    full = _obj(
        _str_member("ticket_type", _pick(i, 3, _EVAL_TYPES)),
        _str_member("severity", _pick(i, 4, _EVAL_SEVERITIES)),
        _str_member("department_impacted", F.concat(F.lit("D"), F.pmod(i, F.lit(2)).cast("string"))),
        _str_member("service_impacted", F.concat(F.lit("S"), F.pmod(i, F.lit(3)).cast("string"))),
        F.when(F.pmod(i, F.lit(5)) != 0, F.lit('"preferred_communication": "email"')),
        F.when(F.pmod(i, F.lit(3)) == 2, F.lit('"assistance_request": "loan"')),
    )
    return F.when(F.pmod(i, F.lit(12)) == 0, F.lit(OOD_JSON)).otherwise(full)


_REPLIES = [
    "I cannot help with that.",
    'Sure: {"ticket_type": "complaint" } extra }',
    OOD_JSON,
    '{"severity": "low"}',
    '{"ticket_type": "complaint", "severity": "low"}',
    'Here: \n{"ticket_type": "inquiry",\n "severity": "high"}\nThanks',
]


def reply(i: Column, truth: Column) -> Column:
    k = F.pmod(i, F.lit(11))
    body = F.when(k < len(_REPLIES), _pick(i, 11, _REPLIES + [None] * (11 - len(_REPLIES)))).otherwise(truth)
    return F.concat(F.lit("[INST] sys [/INST] "), body)


def eval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_id, user_input, true_json, response``: truth and a model reply."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    return (d.select(i.alias("sample_id"), F.col("text").alias("user_input"),
                     true_json(i).alias("true_json"))
            .withColumn("response", reply(F.col("sample_id"), F.col("true_json"))))


def _sample_ticket(i: Column) -> Column:
    """Ticket members of raw sample ``i``; one key dropped or nulled by rule."""
    d = F.pmod(i, F.lit(40))
    values = {
        "ticket_type": _pick(i, 3, _EVAL_TYPES),
        "title": F.concat(F.lit("Title "), i.cast("string")),
        "description": F.concat(F.lit("Description "), i.cast("string")),
        "severity": _pick(i, 4, _EVAL_SEVERITIES),
        "department_impacted": F.concat(F.lit("Dept "), F.pmod(i, F.lit(5)).cast("string")),
        "service_impacted": F.concat(F.lit("Service "), F.pmod(i, F.lit(3)).cast("string")),
        "preferred_communication": F.lit("email"),
    }
    members = []
    for k, field in enumerate(TICKET_FIELDS):
        m = _str_member(field, values[field])
        if field == "title":
            m = F.when(d == 10, F.lit('"title": null')).otherwise(m)
        members.append(F.when(d != 3 + k, m))
    return F.when(F.pmod(i, F.lit(12)) == 0, F.lit(OOD_JSON)).otherwise(_obj(*members))


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_id, sample_json``: sample objects as JSON text, where key
    absence survives (validator input)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    r = F.pmod(i, F.lit(40))
    user = F.when(r != 1, F.concat(F.lit('"user_input": '), quote(F.col("text"))))
    ticket = F.when(r != 2, F.concat(F.lit('"ticket_data": '), _sample_ticket(i)))
    return d.select(i.alias("sample_id"), _obj(user, ticket).alias("sample_json"))
