"""Named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables (or fixtures Spark derives from them)
and returns a lazily planned DataFrame; a few compute small scalars first
(histogram range, report totals)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom import fixed_values as FV
from ticketloom.functions import jsonx
from ticketloom.functions.json_errors import error_text, first_error
from ticketloom.functions.text import py_strip
from ticketloom.operators import clean as CL
from ticketloom.operators import heavy as HV
from ticketloom.operators import keywords as KW
from ticketloom.operators import metrics as MT
from ticketloom.operators import phrases as PH
from ticketloom.operators import profile as PR
from ticketloom.operators import records as RC
from ticketloom.operators import responses as RS
from ticketloom.operators import sampling as SM
from ticketloom.operators import scoring as SC
from ticketloom.operators import summaries as SU
from ticketloom.session import scratch_path
from ticketloom.sources import files as FI
from ticketloom.streaming import score_stream as ST
from ticketloom.sources import fixtures as FX
from ticketloom.sources import literals as LT
from ticketloom.sources import splitting as SP
from ticketloom.sources.tables import read_table

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Builder] = {}


def query(name: str):
    def deco(fn: Builder) -> Builder:
        CATALOG[name] = fn
        return fn
    return deco


# -- shared stages ------------------------------------------------------------

def raw(spark, sf) -> DataFrame:
    return FX.raw_tickets(spark, sf)


def parsed(spark, sf) -> DataFrame:
    return CL.parse_tickets(raw(spark, sf))


def clean(spark, sf) -> DataFrame:
    return CL.clean_tickets(parsed(spark, sf))


_CLEAN_COLS = ["row_index", "ticket_type", "severity", "preferred_communication", "title",
               "description", "department_impacted", "service_impacted", "assistance_request"]


# -- parsing and cleaning -----------------------------------------------------

@query("parse_counts")
def q_parse_counts(spark, sf):
    return CL.parse_counts(raw(spark, sf))


@query("parse_tickets")
def q_parse_tickets(spark, sf):
    return parsed(spark, sf).drop("obj", "obj_text")


@query("clean_tickets")
def q_clean_tickets(spark, sf):
    return clean(spark, sf).select(*_CLEAN_COLS)


@query("type_distribution")
def q_type_distribution(spark, sf):
    return PR.distribution(clean(spark, sf), "ticket_type")


@query("severity_distribution")
def q_severity_distribution(spark, sf):
    return PR.distribution(clean(spark, sf), "severity")


# -- filters on parsed / cleaned tickets --------------------------------------

@query("discover_keys")
def q_discover_keys(spark, sf):
    return CL.discover_keys(parsed(spark, sf))


def event_props(spark, sf) -> DataFrame:
    return read_table(spark, sf, "events", "event_id", "props").withColumnRenamed("props", "output")


@query("event_props_parse")
def q_event_props_parse(spark, sf):
    """P2 at volume: strict JSON parse of every events.props value."""
    return CL.parse_counts(event_props(spark, sf))


@query("event_props_keys")
def q_event_props_keys(spark, sf):
    """P3 at volume: keys of every events.props object."""
    return CL.discover_keys(CL.keep_parsed(event_props(spark, sf)))


@query("assistance_tickets")
def q_assistance_tickets(spark, sf):
    return CL.assistance_tickets(parsed(spark, sf))


@query("high_severity")
def q_high_severity(spark, sf):
    return CL.high_severity(clean(spark, sf))


@query("non_standard_types")
def q_non_standard_types(spark, sf):
    """F4 on the uncleaned type (after cleaning it can never fire)."""
    return CL.non_standard_types(parsed(spark, sf))


@query("very_short_inputs")
def q_very_short_inputs(spark, sf):
    return CL.very_short_inputs(parsed(spark, sf))


@query("clean_by_lookup_join")
def q_clean_by_lookup_join(spark, sf):
    """JN1 at volume: order priorities normalised through the severity
    spellings as a mapping table (broadcast after a size check)."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    key = py_strip(F.lower(F.substring_index(F.col("o_orderpriority"), "-", -1)))
    m = CL.mapping_frame(spark, FV.SEVERITY_MAPPING)
    return CL.clean_by_lookup(o, key, m, FV.SEVERITY_DEFAULT, "severity").select("o_orderkey", "severity")


# -- profile ------------------------------------------------------------------

@query("dataset_overview")
def q_dataset_overview(spark, sf):
    return PR.dataset_overview(raw(spark, sf))


@query("raw_distributions")
def q_raw_distributions(spark, sf):
    return PR.raw_distributions(parsed(spark, sf))


@query("quality_summary")
def q_quality_summary(spark, sf):
    return PR.quality_summary(clean(spark, sf))


@query("missing_values")
def q_missing_values(spark, sf):
    return PR.missing_values(clean(spark, sf))


@query("length_stats")
def q_length_stats(spark, sf):
    return PR.length_stats(parsed(spark, sf))


@query("profile_by_day")
def q_profile_by_day(spark, sf):
    """A4 and A6 from stored summaries: six days (by id) are stored, a seventh is added without reading the others
    again, and the merged profile of each language is held against a full run."""
    d = read_table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    d = d.withColumn("day", F.pmod("doc_id", F.lit(7)).cast("int")).withColumn("digest", PR.text_digest("text"))
    path, what = scratch_path(spark, "day_summaries"), (["lang"], "text", ["source", "digest"])
    for days in ("day < 6", "day = 6"):
        SU.store_summaries(SU.day_summaries(d.where(days), "day", *what), "day", path)
    merged = SU.merge_summaries(SU.read_summaries(spark, path), ["lang"])
    return SU.check_profile(SU.summary_profile(merged, ["lang"]), d, *what)


@query("document_length_stats")
def q_document_length_stats(spark, sf):
    d = read_table(spark, sf, "documents", "text")
    return PR.length_stats(d, "text")


@query("duplicate_inputs")
def q_duplicate_inputs(spark, sf):
    return PR.duplicate_count(parsed(spark, sf))


@query("duplicate_rows")
def q_duplicate_rows(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return PR.duplicate_rows(d, "text", "doc_id")


@query("length_histogram")
def q_length_histogram(spark, sf):
    return PR.length_histogram(parsed(spark, sf))


@query("top_departments")
def q_top_departments(spark, sf):
    c = clean(spark, sf)
    return PR.distribution(c, "department_impacted", top=FV.TOP_DEPARTMENTS)


@query("quality_report")
def q_quality_report(spark, sf):
    return PR.quality_report(clean(spark, sf))


# -- text mining --------------------------------------------------------------

@query("word_tokens")
def q_word_tokens(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return KW.word_tokens(d, "doc_id", "text")


@query("word_counts")
def q_word_counts(spark, sf):
    d = read_table(spark, sf, "documents", "lang", "text")
    return KW.word_counts(d, "text", "lang")


@query("class_keywords")
def q_class_keywords(spark, sf):
    return KW.class_keywords(clean(spark, sf))


@query("lang_keywords")
def q_lang_keywords(spark, sf):
    """T3 over the whole documents table, class = language."""
    d = read_table(spark, sf, "documents", "lang", "text")
    return KW.class_keywords(d, "text", "lang", classes=None)


@query("heavy_lang_keywords")
def q_heavy_lang_keywords(spark, sf):
    """T2-T6 from bounded summaries and an exact recount of the candidates, class = language."""
    d = read_table(spark, sf, "documents", "lang", "text")
    counts = HV.heavy_word_counts(d, "text", ["lang"], FV.TYPE_KEYWORDS_TOP)
    return KW.top_keywords(counts, ["lang"], FV.TYPE_KEYWORDS_TOP, FV.TYPE_STOPWORDS)


@query("high_severity_keywords")
def q_high_severity_keywords(spark, sf):
    return KW.high_severity_keywords(clean(spark, sf))


@query("class_keywords_top5")
def q_class_keywords_top5(spark, sf):
    return KW.printed_keywords(KW.keyword_patterns(clean(spark, sf)))


# -- records, loaders, validators ---------------------------------------------

def records(spark, sf) -> DataFrame:
    return RC.training_records(clean(spark, sf))


def validated(spark, sf) -> DataFrame:
    return RC.validate_samples(FX.raw_samples(spark, sf))


def loaded(spark, sf) -> DataFrame:
    return RC.load_with_defaults(raw(spark, sf))


_SAMPLE_OUT = [c for c in RC.SAMPLE_COLUMNS if c != "source"]


@query("training_records")
def q_training_records(spark, sf):
    return records(spark, sf).select(*_SAMPLE_OUT)


@query("records_without_department")
def q_records_without_department(spark, sf):
    """P9's column default: no ticket has a department."""
    r = raw(spark, sf).withColumn("output", F.regexp_replace("output", r'"Department Impacted": "Dept \d+", ', ""))
    return RC.training_records(CL.clean_tickets(CL.parse_tickets(r))).select(*_SAMPLE_OUT)


@query("assistance_request")
def q_assistance_request(spark, sf):
    r = records(spark, sf)
    return r.where(F.col("assistance_request").isNotNull()).select("sample_id", "assistance_request")


@query("load_defaults")
def q_load_defaults(spark, sf):
    return loaded(spark, sf).where("_ok").select(*_SAMPLE_OUT)


@query("load_defaults_events")
def q_load_defaults_events(spark, sf):
    """P7 at volume: every events.props object, whose keys are others, so
    that each default is filled in."""
    e = read_table(spark, sf, "events", "event_id", "props")
    rows = e.select(F.col("event_id").alias("row_index"), F.col("props").alias("input"), F.col("props").alias("output"))
    return RC.load_with_defaults(rows).where("_ok").select(*_SAMPLE_OUT)


@query("load_defaults_counts")
def q_load_defaults_counts(spark, sf):
    return RC.counts_of(loaded(spark, sf), "rows", "loaded", "skipped")


@query("validate_samples")
def q_validate_samples(spark, sf):
    return validated(spark, sf).where("_ok").select(*_SAMPLE_OUT)


@query("validate_counts")
def q_validate_counts(spark, sf):
    return RC.counts_of(validated(spark, sf), "loaded", "valid", "skipped")


def combined(spark, sf) -> DataFrame:
    """Validated JSON samples + loader samples + synthetic edge cases."""
    return RC.combine_samples(validated(spark, sf).where("_ok"), loaded(spark, sf).where("_ok"),
                              LT.synthetic_samples(spark))


@query("combined_samples")
def q_combined_samples(spark, sf):
    return combined(spark, sf).drop(RC.TYPED)


@query("chat_messages")
def q_chat_messages(spark, sf):
    return RC.chat_messages_long(records(spark, sf)).drop("source")


@query("training_prompts")
def q_training_prompts(spark, sf):
    r = records(spark, sf)
    return r.select("sample_id", RC.training_prompt("inst").alias("prompt"))


@query("inference_prompts")
def q_inference_prompts(spark, sf):
    """P13 over every user turn of the conversations table."""
    c = read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user")
    return u.select("conv_id", "turn", RC.inference_prompt("text").alias("prompt"))


@query("inference_prompts_chat")
def q_inference_prompts_chat(spark, sf):
    r = records(spark, sf)
    return r.select("sample_id", RC.generation_prompt("inst").alias("prompt"))


@query("prompt_truncation")
def q_prompt_truncation(spark, sf):
    e = FX.eval_pairs(spark, sf)
    return RC.prompt_budget(e, ["sample_id"], "user_input", FV.EVAL_MAX_TOKENS)


@query("training_prompt_budget")
def q_training_prompt_budget(spark, sf):
    """P15 in training: the full chat prompt (system, input, reply JSON)
    against the 2,048-token budget."""
    return RC.prompt_budget(records(spark, sf), ["sample_id"], "user_input", FV.TRAIN_MAX_TOKENS,
                            template="inst", system=FV.TRAINING_SYSTEM_PROMPT, with_reply=True)


@query("sample_preview")
def q_sample_preview(spark, sf):
    v = validated(spark, sf).where("_ok")
    first = v.orderBy("sample_id").limit(3)
    return first.select("sample_id", F.substring("user_input", 1, 100).alias("preview"),
                        "ticket_type", "severity",
                        F.length(RC.training_prompt("inst")).cast("bigint").alias("prompt_chars"))


# -- balancing, shuffling, splitting ------------------------------------------

@query("balance_classes")
def q_balance_classes(spark, sf):
    c = clean(spark, sf).select("row_index", "ticket_type")
    return SM.balance_classes(c, "ticket_type", "row_index", FV.BALANCE_TARGET)


@query("balance_orders")
def q_balance_orders(spark, sf):
    """B1 on a real table: orders balanced by priority, 3,000 per class, with
    one-digit buckets, so that the cut buckets hold many rows."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    return SM.balance_classes(o, "o_orderpriority", "o_orderkey", 3000, digits=1)


@query("balanced_distribution")
def q_balanced_distribution(spark, sf):
    b = q_balance_classes(spark, sf)
    return b.groupBy(F.col("ticket_type").alias("value")).agg(F.count("*").alias("n"))


@query("shuffle_rows")
def q_shuffle_rows(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id")
    return SM.shuffle_rows(d, "doc_id")


def three_way(spark, sf) -> DataFrame:
    r = records(spark, sf)
    return SM.split_three_way(r, ["sample_id"], FV.SPLIT_RATIOS, FV.SEED,
                              extra_test=LT.ood_samples(spark))


@query("split_three_way")
def q_split_three_way(spark, sf):
    return three_way(spark, sf).select("sample_id", "split")


@query("split_orders")
def q_split_orders(spark, sf):
    """B3 on a real table, with one-digit hash prefixes: the cuts lie inside
    prefixes that hold many rows."""
    o = read_table(spark, sf, "orders", "o_orderkey")
    return SM.split_three_way(o, ["o_orderkey"], FV.SPLIT_RATIOS, FV.SEED, digits=1)


@query("split_distribution")
def q_split_distribution(spark, sf):
    return SM.split_distribution(three_way(spark, sf))


@query("split_train_eval")
def q_split_train_eval(spark, sf):
    s = combined(spark, sf)
    return SM.split_train_eval(s, ["source", "sample_id"]).select("source", "sample_id", "split")


@query("split_leakage")
def q_split_leakage(spark, sf):
    return SM.split_leakage(three_way(spark, sf)).select("sample_id")


# -- evaluation ---------------------------------------------------------------

def evaluated(spark, sf) -> DataFrame:
    return RS.outcomes(FX.eval_pairs(spark, sf))


@query("parse_responses")
def q_parse_responses(spark, sf):
    p = RS.parse_replies(FX.eval_pairs(spark, sf))
    return p.select("sample_id", "status", "pred_has_error", "pred_error",
                    jsonx.as_text(jsonx.value("pred", "ticket_type")).alias("ticket_type"),
                    jsonx.as_text(jsonx.value("pred", "severity")).alias("severity"), "raw")


@query("reply_json_errors")
def q_reply_json_errors(spark, sf):
    """The decoder's message for truth texts that are damaged in six ways (every seventh stays whole)."""
    e = FX.eval_pairs(spark, sf)
    j, n, kind = F.col("true_json"), F.length("true_json"), F.col("sample_id") % 7
    colon, comma = F.instr(j, ":"), F.instr(j, '", "')
    cut = lambda text, at: F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text)))
    damaged = (F.when(kind == 0, F.concat(j, F.lit(" extra"))).when(kind == 1, F.concat(F.substring(j, F.lit(1), colon - 1), F.lit(";"), F.substring(j, colon + 1, n)))
               .when(kind == 2, F.substring(j, F.lit(1), n - 1)).when((kind == 3) & (comma > 0), cut(j, comma + 1))
               .when(kind == 4, F.concat(F.lit("{\n"), F.substring(j, F.lit(3), n))).when(kind == 5, F.concat(F.substring(j, F.lit(1), n - 1), F.lit(", }")))
               .otherwise(j))
    e = jsonx.materialize(e.select("sample_id", damaged.alias("text")), fault=first_error(F.col("text")))
    return e.select("sample_id", error_text(F.col("text"), F.col("fault")).alias("message"))


@query("quick_eval_labels")
def q_quick_eval_labels(spark, sf):
    return RS.quick_labels(FX.eval_pairs(spark, sf))


@query("quick_eval_metrics")
def q_quick_eval_metrics(spark, sf):
    """A9/A10 over the quick check's labels (the training script's report)."""
    return MT.class_metrics(RS.quick_labels(FX.eval_pairs(spark, sf)))


@query("outcome_labels")
def q_outcome_labels(spark, sf):
    return evaluated(spark, sf).select("sample_id", "status", "outcome", "true_label", "pred_label")


@query("eval_detailed")
def q_eval_detailed(spark, sf):
    e = evaluated(spark, sf).where(F.col("outcome") == "compared")
    return e.select("sample_id", "true_label", "pred_label", "type_correct", *RS.MATCH_COLUMNS)


@query("overall_accuracy")
def q_overall_accuracy(spark, sf):
    return MT.overall_accuracy(evaluated(spark, sf))


@query("class_metrics")
def q_class_metrics(spark, sf):
    return MT.class_metrics(evaluated(spark, sf))


@query("avg_metrics")
def q_avg_metrics(spark, sf):
    return MT.avg_metrics(MT.class_metrics(evaluated(spark, sf)))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return MT.confusion_matrix(evaluated(spark, sf))


@query("dense_confusion_matrix")
def q_dense_confusion_matrix(spark, sf):
    """JN3: all cells of the matrix, zeros too."""
    blocks = MT.dense_grid(evaluated(spark, sf))
    return blocks.select("true_label", F.inline(F.arrays_zip("pred_labels", "counts")).alias("pred_label", "n"))


@query("label_set")
def q_label_set(spark, sf):
    return MT.label_set(evaluated(spark, sf))


@query("field_accuracy")
def q_field_accuracy(spark, sf):
    return MT.field_accuracy(evaluated(spark, sf)).select("field", "accuracy")


@query("error_rates")
def q_error_rates(spark, sf):
    return MT.error_rates(evaluated(spark, sf))


@query("error_shares")
def q_error_shares(spark, sf):
    return MT.error_shares(evaluated(spark, sf))


@query("sample_predictions")
def q_sample_predictions(spark, sf):
    return MT.sample_predictions(evaluated(spark, sf))


@query("labels_class_metrics")
def q_labels_class_metrics(spark, sf):
    """A10 on a real join: truth from labels.quality, prediction from the
    document length (labels JOIN documents on doc_id)."""
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    doc = read_table(spark, sf, "documents", "doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    t = F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("bad"))
    p = F.when(F.col("n_chars") >= 1000, F.lit("good")).otherwise(F.lit("bad"))
    return MT.class_metrics(j.select(t.alias("true_label"), p.alias("pred_label")))


def evaluated_labels(spark, sf) -> DataFrame:
    """The narrow per-row result every metric reads (labels and match
    flags), checkpointed once so the five report branches do not re-parse
    replies; texts and parsed maps are left behind."""
    e = evaluated(spark, sf).select("sample_id", "outcome", "true_label", "pred_label", "type_correct",
                                    *RS.MATCH_COLUMNS)
    return e.checkpoint(eager=True)


@query("eval_report")
def q_eval_report(spark, sf):
    return MT.eval_report(evaluated_labels(spark, sf))


@query("eval_summary")
def q_eval_summary(spark, sf):
    return MT.eval_summary(evaluated_labels(spark, sf))


# -- file sources and sinks ---------------------------------------------------

@query("scan_raw_tickets")
def q_scan_raw_tickets(spark, sf):
    """Raw tickets written as CSV to the shared folder, scanned back
    with pandas' CSV semantics."""
    path = FI.write_tickets_csv(raw(spark, sf), scratch_path(spark, "raw_tickets_csv"))
    return FI.read_tickets_csv(spark, path)


@query("scan_keyless_tickets")
def q_scan_keyless_tickets(spark, sf):
    """A CSV of only ``input, output``; rows are numbered in file order."""
    rows = raw(spark, sf).orderBy("row_index").select("input", "output")
    return FI.read_tickets_csv(spark, FI.write_tickets_csv(rows, scratch_path(spark, "keyless_tickets_csv")))


@query("scan_sample_array")
def q_scan_sample_array(spark, sf):
    """JSON arrays in several files, with null inputs and tickets that are
    no objects among them."""
    r = FX.raw_samples(spark, sf)
    odd = (F.when(F.col("sample_id") % 37 == 5, F.regexp_replace("sample_json", r'(?s)^\{"user_input": ".*?", "ticket_data"',
                                                                 '{"user_input": null, "ticket_data"'))
           .when(F.col("sample_id") % 41 == 7, F.lit('{"user_input": "x", "ticket_data": "plain text"}'))
           .otherwise(F.col("sample_json")))
    path = FI.write_sample_arrays(r.select("sample_id", odd.alias("sample_json")), scratch_path(spark, "sample_arrays"))
    return FI.read_sample_array(spark, path).where("_ok").drop("_ok", "source", "sample_id", RC.TYPED)


# small ranges, so that the test tables' files have many of them
RANGE_BYTES = 256 << 10


@query("scan_split_tickets")
def q_scan_split_tickets(spark, sf):
    """CSV files of ``input, output`` with line breaks and quotes in their fields, one for each 64 MB of
    text, read in ranges of 256 KB; rows are numbered by their place."""
    rows = raw(spark, sf)
    rows = rows.repartitionByRange(FI.files_for(rows, "input", "output"), "row_index").sortWithinPartitions("row_index")
    path = FI.write_tickets_csv(rows.select("input", "output"), scratch_path(spark, "large_csv"))
    return FI.read_tickets_csv(spark, path, split=True, range_size=RANGE_BYTES)


@query("scan_split_array")
def q_scan_split_array(spark, sf):
    """JSON arrays in files of about 64 MB (K1), read in ranges of 256 KB; elements are numbered by their place."""
    recs = records(spark, sf)
    path = FI.write_sample_array(recs, scratch_path(spark, "large_array"), ["sample_id"], per_file=None)
    back = FI.read_sample_array(spark, path, split=True, range_size=RANGE_BYTES)
    return back.where("_ok").select(*_SAMPLE_OUT)


@query("write_training_array")
def q_write_training_array(spark, sf):
    """Training records as JSON arrays of 300 elements in the bytes of ``json.dump(list, indent=2)``;
    number, size and hash of each file in the order of their names."""
    path = FI.write_sample_array(records(spark, sf), scratch_path(spark, "training_array"), ["sample_id"], per_file=300)
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    rank = F.row_number().over(Window.orderBy("name"))        # a row a file
    facts = files.select("name", F.octet_length("value").cast("bigint").alias("n_bytes"), F.sha2("value", 256).alias("sha256"))
    return facts.select((rank - 1).cast("bigint").alias("part"), "n_bytes", "sha256")


@query("numbered_samples")
def q_numbered_samples(spark, sf):
    """JSON lines numbered by file and line, in ranges of 256 KB."""
    rows = FX.raw_samples(spark, sf).orderBy("sample_id").select(F.col("sample_json").alias("value"))
    path = scratch_path(spark, "sample_lines")
    rows.write.text(path)
    return FI.read_numbered_samples(spark, path, RANGE_BYTES).where("_ok").select(*_SAMPLE_OUT)


@query("paired_outcomes")
def q_paired_outcomes(spark, sf):
    """JN2/B6/E3: truth and replies in two files without keys, paired by line although the files are cut
    differently; the last tenth of the truth has no reply, as the replies end before."""
    e = FX.eval_pairs(spark, sf)
    t, p = scratch_path(spark, "truth_lines"), scratch_path(spark, "reply_lines")
    e.orderBy("sample_id").select(F.to_json(F.struct("user_input", "true_json")).alias("value")).write.text(t)
    top = e.agg(F.max("sample_id")).scalar()
    (e.where(F.col("sample_id") < top * 9 / 10).orderBy("sample_id").coalesce(1)
     .select(F.to_json(F.struct("response")).alias("value")).write.text(p))
    with SP.range_bytes(spark, RANGE_BYTES):
        truth = SP.numbered_lines(spark, t)
    with SP.range_bytes(spark, RANGE_BYTES // 4):
        replies = SP.numbered_lines(spark, p)
    pairs = RS.pair_by_position(truth, replies)
    read = lambda line, c: F.get_json_object(line, f"$.{c}")
    df = pairs.select("sample_id", read("truth_line", "user_input").alias("user_input"), read("truth_line", "true_json").alias("true_json"),
                      read("prediction_line", "response").alias("response"))
    return RS.outcomes(df).select("sample_id", "status", "outcome", "true_label", "pred_label")


@query("write_samples")
def q_write_samples(spark, sf):
    """K1 + S2: training records written as JSON lines, read back and
    validated."""
    recs = RC.require_rows(records(spark, sf), "No data loaded. Please provide a data source.")
    path = FI.write_samples_jsonl(recs, scratch_path(spark, "training_data"))
    # JSON lines carry no key: the read-local row label is dropped
    return FI.read_samples_jsonl(spark, path).where("_ok").drop("_ok", "source", "sample_id", RC.TYPED)


@query("write_splits")
def q_write_splits(spark, sf):
    """K2: train / validation / test (+ out-of-domain rows) and the
    challenge set in one write, one folder per split; read back."""
    splits = three_way(spark, sf).unionByName(
        LT.challenge_samples(spark).withColumn("split", F.lit("challenge")), allowMissingColumns=True)
    path = FI.write_samples_jsonl(splits, scratch_path(spark, "data_splits"), partition_by="split")
    back = FI.read_samples_jsonl(spark, path).where("_ok")
    return back.select("split", "user_input", "ticket_type", "severity", "error")


@query("write_eval_results")
def q_write_eval_results(spark, sf):
    """K5: detailed evaluation results written as JSON lines, read back."""
    path = FI.write_eval_results(evaluated(spark, sf), scratch_path(spark, "evaluation_results"))
    back = spark.read.text(f"{path}/detailed_results")
    m = jsonx.with_object(back, F.col("value"), "r")
    return m.select(jsonx.as_text(jsonx.value("r", "type_correct")).alias("type_correct"),
                    jsonx.as_text(jsonx.value("r", "field_match")).alias("field_match"))


@query("write_eval_metrics")
def q_write_eval_metrics(spark, sf):
    """K5: the metrics of the results folder, read back."""
    path = FI.write_eval_results(evaluated(spark, sf), scratch_path(spark, "evaluation_results"))
    return spark.read.schema("section string, key string, metric string, value double").json(f"{path}/metrics")


# -- scoring and streaming ----------------------------------------------------

@query("batch_score")
def q_batch_score(spark, sf):
    """V1: every evaluation input scored by a caller-supplied model (here
    the rule model) in Arrow batches, then parsed (E1)."""
    e = FX.eval_pairs(spark, sf).select("sample_id", "user_input")
    scored = SC.score(e, SC.rule_model)
    p = RS.parse_replies(scored)
    return p.select("sample_id", "status", jsonx.as_text(jsonx.value("pred", "ticket_type")).alias("ticket_type"))


@query("domain_filter")
def q_domain_filter(spark, sf):
    """V4: keyword score of every evaluation input against the per-type
    keyword lists (T3); below 1 -> out of domain, with its error ticket."""
    kw = KW.class_keywords(clean(spark, sf)).agg(F.collect_set("word")).scalar()
    e = FX.eval_pairs(spark, sf).select("sample_id", "user_input")
    return SC.domain_scores(e, kw).select("sample_id", "domain_score", "in_domain", "error")


@query("phrase_filter")
def q_phrase_filter(spark, sf):
    """V4 with a large list: each document's matches of every one to three words in a row of ``benchmark``, in
    domain from five different ones."""
    w = F.col("w")
    b = read_table(spark, sf, "benchmark", "text").select(PH.ascii_words("text").alias("w"))
    runs = F.concat(*(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
                      for n in (1, 2, 3)))
    phrases = b.where(F.size("w") >= 3).select(F.explode(runs).alias("phrase"))
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return PH.phrase_scores(d, phrases, "doc_id", "text", threshold=5)


@query("fit_classifier")
def q_fit_classifier(spark, sf):
    """V2: a text classifier fitted on the train rows of the cleaned tickets
    (label = ticket type) and scored on the test rows."""
    t = clean(spark, sf).select("row_index", "original_input", "ticket_type")
    parts = SM.split_three_way(t, ["row_index"], (0.8, 0.0, 0.2))
    test = parts.where(F.col("split") == "test")
    model = SC.fit_classifier(parts.where(F.col("split") == "train"), "original_input", "ticket_type")
    pred = SC.classify(model, test, "original_input", "row_index")
    return test.select("row_index", F.col("ticket_type").alias("true_label")).join(pred, "row_index")


@query("classifier_metrics")
def q_classifier_metrics(spark, sf):
    """A10 over the classifier's test predictions."""
    return MT.class_metrics(q_fit_classifier(spark, sf))


@query("document_tf_idf")
def q_document_tf_idf(spark, sf):
    """V2's features: TF-IDF weights of every word of every document."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return SC.tf_idf(d, "text", "doc_id").withColumn("tfidf", F.round("tfidf", 9))


def _languages(spark, sf):
    """Documents split by hash, to learn their language from four fifths."""
    d = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    parts = SM.split_three_way(d, ["doc_id"], (0.8, 0.0, 0.2))
    return parts.where(F.col("split") == "train"), parts.where(F.col("split") == "test")


@query("fit_logistic")
def q_fit_logistic(spark, sf):
    """V2: TF-IDF with logistic regression fitted on the train documents' language, and the optimum's first
    condition: the probability mass of each label over the train rows, rounded, is their number."""
    train, _ = _languages(spark, sf)
    model = SC.fit_logistic(train, "text", "lang", features=1 << 14, tolerance=1e-7)
    return SC.label_mass(model, train.where("lang IS NOT NULL"), "text").select("label", F.round("mass").cast("bigint").alias("n_rows"))


def classifier_comparison(spark, sf) -> DataFrame:
    """A9 on held-out documents: logistic regression beside naive Bayes (a fit has no SQL; tested)."""
    train, test = _languages(spark, sf)
    truth = test.select("doc_id", F.col("lang").alias("true_label"))
    logistic = SC.classify_logistic(SC.fit_logistic(train, "text", "lang"), test, "text", "doc_id")
    bayes = SC.classify(SC.fit_classifier(train, "text", "lang"), test, "text", "doc_id")
    out = logistic.withColumn("model", F.lit("logistic")).unionByName(bayes.withColumn("model", F.lit("naive_bayes")))
    return (out.join(truth, "doc_id").groupBy("model")
            .agg(F.count("*").alias("n_rows"), F.round(F.avg((F.col("true_label") == F.col("pred_label")).cast("int")), 6).alias("accuracy")))


def scored_evaluation(spark, sf) -> DataFrame:
    """E5: prompt (P13) -> model (V1) -> replies joined to the truth (JN2) ->
    outcomes (E1, E3, E4)."""
    e = FX.eval_pairs(spark, sf)
    prompts = e.select("sample_id", RC.inference_prompt("user_input").alias("prompt"))
    replies = SC.score(prompts, SC.rule_model, text_col="prompt").select("sample_id", "response")
    return RS.outcomes(RS.join_predictions(e.select("sample_id", "user_input", "true_json"), replies))


@query("scored_eval_labels")
def q_scored_eval_labels(spark, sf):
    return scored_evaluation(spark, sf).select("sample_id", "outcome", "true_label", "pred_label")


@query("scored_eval_report")
def q_scored_eval_report(spark, sf):
    e = scored_evaluation(spark, sf).select("sample_id", "outcome", "true_label", "pred_label", "type_correct", *RS.MATCH_COLUMNS)
    return MT.eval_report(e.checkpoint(eager=True))


@query("stream_score")
def q_stream_score(spark, sf):
    """V3: user turns of the conversations table as a stream (availableNow),
    blank ones dropped, scored and parsed into a parquet sink."""
    schema = "conv_id bigint, turn bigint, role string, text string"
    src = f"{sf.rstrip('/')}/conversations*.parquet"
    out = scratch_path(spark, "stream_out")
    res = ST.run_available(spark, src, schema, SC.rule_model, "text", out, out + "_ckpt",
                           where="role = 'user'")
    return res.select("conv_id", "turn", "status", "pred_has_error")
