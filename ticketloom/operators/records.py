"""Samples, loaders, validators, training records, messages and prompts
(P7-P16, F6-F8, U1, S3-S5 wiring).

A *sample* is one flat row: ``source, sample_id, user_input`` plus the
ticket fields (``ticket_type .. preferred_communication``), the optional
``assistance_request`` (null = key absent) and ``error`` (null = not an
out-of-domain ticket).  JSON text is rendered by column expressions with
the exact key-presence rules; nothing leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed_values import (
    ASSISTANCE_FALLBACK, ASSISTANCE_KEYWORDS, EVAL_MAX_TOKENS, EVAL_PROMPT_TEMPLATE,
    EVAL_SYSTEM_PROMPT, LOADER_ASSISTANCE_REQUEST, LOADER_DEFAULTS, OPTIONAL_FIELD,
    RECORD_COLUMN_DEFAULTS, TICKET_FIELDS, TRAINING_SYSTEM_PROMPT)
from ticketloom.functions import jsonx
from ticketloom.functions.text import tokens

SAMPLE_COLUMNS = ["source", "sample_id", "user_input", *TICKET_FIELDS, OPTIONAL_FIELD, "error"]
# Free fields may hold any JSON value: their columns have its text, and
# ``typed_values`` (field -> JSON text) has those that are no strings.
FREE_FIELDS = {"title": "Title", "description": "Description", "department_impacted": "Department Impacted",
               "service_impacted": "Service Impacted"}
TYPED = "typed_values"


def typed_values(m, keys: dict[str, str], text: Column) -> Column:
    """map<field, JSON text> of the free fields whose value is neither a
    string nor null.  The text is cut from ``text``, the object's own, so
    that nested members keep their order."""
    def entry(field, key):
        v = jsonx.value(m, key)
        kind = jsonx.json_type(v)
        return F.struct(F.lit(field).alias("key"), F.when((kind != "STRING") & (kind != "VOID"), jsonx.member_text(text, key)).alias("value"))
    entries = F.filter(F.array(*[entry(f, k) for f, k in keys.items()]), lambda e: e["value"].isNotNull())
    return F.map_from_entries(entries)

# Chat layouts used to render messages (the reference's own layout lives in
# an external tokenizer; these are named, fixed stand-ins).
TEMPLATES = {
    # system folded into the first user turn, reply closed by </s>
    "inst": ("<s>[INST] {system}\n\n{user} [/INST]", "{assistant}</s>"),
    # the evaluation-time layout with a <<SYS>> block
    "sys_block": (EVAL_PROMPT_TEMPLATE, " {assistant}</s>"),
}


# -- builders -----------------------------------------------------------------

def training_records(clean: DataFrame) -> DataFrame:
    """P9 + P10: cleaned tickets -> samples.  A column's default applies when
    no row has its key (pandas then has no such column), never for a null
    value; which keys occur is one row of flags over the table."""
    seen = clean.agg(F.struct(*[F.coalesce(F.bool_or(F.map_contains_key("obj", F.lit(k))), F.lit(False)).alias(k.replace(" ", "_"))
                                for k in RECORD_COLUMN_DEFAULTS])).scalar()

    def col_or_default(name: str, raw_key: str) -> Column:
        return F.when(seen[raw_key.replace(" ", "_")], F.col(name)).otherwise(F.lit(RECORD_COLUMN_DEFAULTS[raw_key])).alias(name)

    desc = F.lower(jsonx.as_string(jsonx.value("obj", "Description")))
    assist = F.lit(ASSISTANCE_FALLBACK)
    for word, label in reversed(ASSISTANCE_KEYWORDS):
        assist = F.when(F.coalesce(desc.contains(word), F.lit(False)), F.lit(label)).otherwise(assist)
    return clean.select(
        F.lit("records").alias("source"), F.col("row_index").alias("sample_id"),
        F.col("original_input").alias("user_input"),
        F.col("ticket_type"), col_or_default("title", "Title"),
        col_or_default("description", "Description"), F.col("severity"),
        col_or_default("department_impacted", "Department Impacted"),
        col_or_default("service_impacted", "Service Impacted"),
        col_or_default("preferred_communication", "Preferred Communication"),
        F.when(F.col("ticket_type") == "assistance", assist).alias(OPTIONAL_FIELD),
        F.lit(None).cast("string").alias("error"), typed_values("obj", FREE_FIELDS, F.col("obj_text")).alias(TYPED))


def load_with_defaults(raw: DataFrame) -> DataFrame:
    """P7 + P8: the alternative loader.  Defaults fill absent keys only;
    type, severity and communication are lower-cased (no strip, no lookup).
    A row is skipped when the output is not a JSON object or one of those
    three keys holds a non-string (JSON null included).  ``_ok`` marks kept
    rows; callers filter or count it."""
    raw = jsonx.with_object(raw, F.col("output"), "_m")
    m = "_m"
    lowered = ["Ticket Type", "Severity", "Preferred Communication"]
    bad_type = F.lit(False)
    for k in lowered:
        v = jsonx.value(m, k)
        bad_type = bad_type | (v.isNotNull() & (jsonx.json_type(v) != "STRING"))
    ok = F.col(m).isNotNull() & ~bad_type
    d = LOADER_DEFAULTS
    ttype = F.lower(jsonx.get_or(m, "Ticket Type", d["Ticket Type"]))
    return raw.select(
        F.lit("loader").alias("source"), F.col("row_index").alias("sample_id"),
        F.col("input").alias("user_input"), ttype.alias("ticket_type"),
        jsonx.get_or(m, "Title", d["Title"]).alias("title"),
        jsonx.get_or(m, "Description", d["Description"]).alias("description"),
        F.lower(jsonx.get_or(m, "Severity", d["Severity"])).alias("severity"),
        jsonx.get_or(m, "Department Impacted", d["Department Impacted"]).alias("department_impacted"),
        jsonx.get_or(m, "Service Impacted", d["Service Impacted"]).alias("service_impacted"),
        F.lower(jsonx.get_or(m, "Preferred Communication", d["Preferred Communication"]))
        .alias("preferred_communication"),
        F.when(ttype == "assistance", F.lit(LOADER_ASSISTANCE_REQUEST)).alias(OPTIONAL_FIELD),
        F.lit(None).cast("string").alias("error"), typed_values(m, FREE_FIELDS, F.col("output")).alias(TYPED),
        ok.alias("_ok"))


def validate_samples(raw_samples: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """a sample is kept when both top-level keys are present and the
    ticket holds ``error`` or all seven ticket keys -- presence, not
    non-null.  ``_ok`` marks kept rows."""
    d = jsonx.with_object(raw_samples, F.col("sample_json"), "_m")
    d = jsonx.with_nested_object(d, "_m", "ticket_data", "_t")
    m, t = "_m", F.col("_t")
    has_all = F.lit(True)
    for f in TICKET_FIELDS:
        has_all = has_all & jsonx.has_key(t, f)
    ok = (jsonx.has_key(m, "user_input") & jsonx.has_key(m, "ticket_data") & t.isNotNull()
          & (jsonx.has_key(t, "error") | has_all))
    cols = [jsonx.as_text(jsonx.value(t, f)).alias(f) for f in TICKET_FIELDS + [OPTIONAL_FIELD, "error"]]
    return d.select(
        F.lit("json").alias("source"), F.col("sample_id"),
        jsonx.as_text(jsonx.value(m, "user_input")).alias("user_input"), *cols,
        typed_values(t, {f: f for f in FREE_FIELDS}, jsonx.member_text("sample_json", "ticket_data")).alias(TYPED),
        F.coalesce(ok, F.lit(False)).alias("_ok"), *keep)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """fail early when there is nothing to train on (one-row probe)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def counts_of(flagged: DataFrame, loaded: str, kept: str, skipped: str) -> DataFrame:
    """loaded / kept / skipped in one aggregate."""
    return flagged.agg(F.count("*").alias(loaded), F.count_if(F.col("_ok")).alias(kept),
                       F.count_if(~F.col("_ok")).alias(skipped))


def combine_samples(*parts: DataFrame) -> DataFrame:
    """UNION ALL by name of sample frames (missing columns -> null)."""
    out = None
    for p in parts:
        p = p.select(*[c for c in [*SAMPLE_COLUMNS, TYPED] if c in p.columns])
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out.select(*SAMPLE_COLUMNS, *([TYPED] if TYPED in out.columns else []))


# -- JSON text and messages ---------------------------------------------------

def ticket_json(indent: bool = True, level: int = 0) -> Column:
    """The bytes of ``json.dumps(ticket_data, indent=2)`` (as it stands
    ``level`` levels deep), or without ``indent`` one line: canonical field
    order, nulls kept as null, values of free fields with their JSON type,
    ``assistance_request`` only when present, error tickets as
    {"error": ...}."""
    nl = "\n" + "  " * (level + 1) if indent else ""
    sep, close = ("," + nl, "\n" + "  " * level + "}") if indent else (", ", "}")
    typed = lambda f: [F.try_element_at(TYPED, F.lit(f))] if f in FREE_FIELDS else []
    shown = lambda f: [F.when(v.isNotNull(), jsonx.py_dumps(v, level=level + 1) if indent else v) for v in typed(f)]
    members = [F.concat(F.lit(f'"{f}": '), F.coalesce(*shown(f), jsonx.py_quote(F.col(f)))) for f in TICKET_FIELDS]
    members.append(F.when(F.col(OPTIONAL_FIELD).isNotNull(),
                          F.concat(F.lit(f'"{OPTIONAL_FIELD}": '), jsonx.py_quote(F.col(OPTIONAL_FIELD)))))
    normal = F.concat(F.lit("{" + nl), F.concat_ws(sep, *members), F.lit(close))
    err = F.concat(F.lit("{" + nl + '"error": '), jsonx.py_quote(F.col("error")), F.lit(close))
    return F.when(F.col("error").isNotNull(), err).otherwise(normal)


def sample_json_line() -> Column:
    """K1: one sample as a JSON object (one line), key presence kept."""
    ticket = ticket_json(indent=False)
    return F.concat(F.lit('{"user_input": '), jsonx.py_quote(F.col("user_input")),
                    F.lit(', "ticket_data": '), ticket, F.lit("}"))


def sample_json_element() -> Column:
    """K1: one sample as ``json.dump(list, indent=2)`` writes an element of
    the list (its first line has no margin)."""
    return F.concat(F.lit('{\n    "user_input": '), jsonx.py_quote(F.col("user_input")),
                    F.lit(',\n    "ticket_data": '), ticket_json(level=2), F.lit("\n  }"))


def chat_messages(samples: DataFrame, with_reply: bool = True) -> DataFrame:
    """P11/P14 as an array<struct<role, content>> column ``messages``."""
    msgs = [F.struct(F.lit("system").alias("role"), F.lit(TRAINING_SYSTEM_PROMPT).alias("content")),
            F.struct(F.lit("user").alias("role"), F.col("user_input").alias("content"))]
    if with_reply:
        msgs.append(F.struct(F.lit("assistant").alias("role"), ticket_json().alias("content")))
    return samples.withColumn("messages", F.array(*msgs))


def chat_messages_long(samples: DataFrame) -> DataFrame:
    """P11 in long form: (source, sample_id, msg_index, role, content)."""
    m = chat_messages(samples)
    return m.select("source", "sample_id", F.posexplode("messages").alias("msg_index", "msg")).select(
        "source", "sample_id", F.col("msg_index").cast("bigint").alias("msg_index"),
        F.col("msg.role").alias("role"), F.col("msg.content").alias("content"))


def _fill(template: str, **cols: Column) -> Column:
    """Render a '{name}' template with column values (concat, no UDF)."""
    parts, rest = [], template
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        j = rest.index("}", i)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(cols[rest[i + 1:j]])
        rest = rest[j + 1:]
    return F.concat(*parts)


def training_prompt(template: str = "inst", system: str = TRAINING_SYSTEM_PROMPT) -> Column:
    """System + user + assistant(JSON) rendered with a named layout."""
    head, tail = TEMPLATES[template]
    return F.concat(_fill(head, system=F.lit(system), user=F.col("user_input")),
                    _fill(tail, assistant=ticket_json()))


def generation_prompt(template: str = "inst", system: str = TRAINING_SYSTEM_PROMPT,
                      user: str = "user_input") -> Column:
    """System + user only, ready for generation."""
    head, _ = TEMPLATES[template]
    return _fill(head, system=F.lit(system), user=F.col(user))


def inference_prompt(user: str = "user_input") -> Column:
    """The evaluation-time prompt."""
    return generation_prompt("sys_block", EVAL_SYSTEM_PROMPT, user)


def prompt_budget(df: DataFrame, id_cols: list[str], user: str = "user_input",
                  max_tokens: int = EVAL_MAX_TOKENS, template: str = "sys_block",
                  system: str = EVAL_SYSTEM_PROMPT, with_reply: bool = False) -> DataFrame:
    """Tokens of the rendered prompt against the budget (512 at
    evaluation, 2048 in training, where the prompt carries the reply JSON).
    The fixed parts of the layout are tokenised once on the driver; every
    junction with a per-row part is whitespace or a one-character token, so
    the count splits exactly and each row tokenises only its own text (and
    its reply)."""
    head, tail = TEMPLATES[template]
    pre, post = head.split("{user}")
    pre = pre.replace("{system}", system)
    const = _count_tokens(pre) + _count_tokens(post)
    n = F.size(tokens(F.col(user))) + F.lit(const)
    if with_reply:
        r_pre, r_post = tail.split("{assistant}")
        n = n + F.size(tokens(ticket_json())) + F.lit(_count_tokens(r_pre) + _count_tokens(r_post))
    return df.select(*id_cols, n.cast("bigint").alias("n_tokens"),
                     F.least(n, F.lit(max_tokens)).cast("bigint").alias("kept_tokens"),
                     (n > max_tokens).alias("truncated"))


def _count_tokens(s: str) -> int:
    """Python count of functions.text.TOKEN matches (word runs of letters,
    digits and '_', or one other non-blank character)."""
    import unicodedata
    n, in_word = 0, False
    for ch in s:
        cat = unicodedata.category(ch)
        word = ch == "_" or cat[0] in ("L", "N")
        if word:
            if not in_word:
                n += 1
            in_word = True
        else:
            in_word = False
            if ch not in " \t\n\r":
                n += 1
    return n
