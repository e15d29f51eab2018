"""Text rendering of the report tables (K3, K4).

The tables are computed on the cluster and are small by construction (a
few dozen rows: one per distinct type, severity, top department, label or
field); only they are collected and formatted here, with Python's own
number formatting (Spark's rounds half up, Python's does not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ticketloom.fixed_values import (
    EVAL_HEADINGS, EVAL_REPORT_TITLE, FIELD_ACCURACY_ORDER, QUALITY_HEADINGS, QUALITY_ISSUE_LINES, QUALITY_REPORT_TITLE)


def _rows(table: DataFrame) -> list[dict]:
    return [r.asDict() for r in table.collect()]


def dense_matrix(cells: list[dict], labels: list) -> tuple[list, list[list[int]]]:
    """The sorted axis and the full matrix of confusion cells, zeros filled in
    (for printing; null sorts last)."""
    axis = sorted(labels, key=lambda x: (x is None, x or ""))
    n = {(c["true_label"], c["pred_label"]): c["n"] for c in cells}
    return axis, [[n.get((t, p), 0) for p in axis] for t in axis]


def render_quality_report(table: DataFrame | list[dict]) -> str:
    rows = table if isinstance(table, list) else _rows(table)
    by = {}
    for r in rows:
        by.setdefault(r["section"], []).append(r)
    for v in by.values():
        v.sort(key=lambda r: (r["ord"], r.get("ord2") or 0))
    ov = {r["key"]: r["n"] for r in by.get("overview", [])}
    out = [QUALITY_REPORT_TITLE, "",
           f"Total Records: {ov.get('Total Records')}",
           f"Unique Ticket Types: {ov.get('Unique Ticket Types')}",
           f"Unique Severities: {ov.get('Unique Severities')}", "", QUALITY_HEADINGS["missing"]]
    for r in by.get("missing", []):
        out.append(f"  {r['key']}: {r['n']} ({r['pct']:.2f}%)")
    for sec in ("ticket_type", "severity", "department"):
        out += ["", QUALITY_HEADINGS[sec]]
        out += [f"  {r['key']}: {r['n']} ({r['pct']:.2f}%)" for r in by.get(sec, [])]
    st = {r["key"]: r["value"] for r in by.get("input_length", [])}
    out += ["", QUALITY_HEADINGS["input_length"],
            f"  Mean: {st.get('Mean', 0):.2f} characters",
            f"  Median: {st.get('Median', 0):.2f} characters",
            f"  Min: {int(st['Min']) if st.get('Min') is not None else None} characters",
            f"  Max: {int(st['Max']) if st.get('Max') is not None else None} characters",
            f"  Std Dev: {st.get('Std Dev') or 0:.2f} characters", "", QUALITY_HEADINGS["issues"]]
    for r in by.get("issues", []):
        out.append(QUALITY_ISSUE_LINES[r["key"]].format(n=r["n"]))
    return "\n".join(out) + "\n"


def render_eval_report(table: DataFrame | list[dict], samples: DataFrame | list[dict] | None = None) -> str:
    rows = table if isinstance(table, list) else _rows(table)
    get = {(r["section"], r["key"], r["metric"]): r["value"] for r in rows}
    out = [EVAL_REPORT_TITLE, "", EVAL_HEADINGS[0], "-" * 50,
           f"Overall Accuracy: {get.get(('overall', 'all', 'accuracy')) or 0:.4f}",
           f"Total Samples Evaluated: {int(get.get(('overall', 'all', 'total_samples')) or 0)}", "",
           EVAL_HEADINGS[1], "-" * 50]
    for label in sorted({k for (s, k, _) in get if s == "class"}, key=lambda k: (k is None, k or "")):
        out += ["", f"{label}:",
                f"  Precision: {get[('class', label, 'precision')]:.4f}",
                f"  Recall: {get[('class', label, 'recall')]:.4f}",
                f"  F1-Score: {get[('class', label, 'f1')]:.4f}",
                f"  Support: {int(get[('class', label, 'support')])}"]
    out += ["", "Macro Average:"]
    for m, name in (("precision", "Precision"), ("recall", "Recall"), ("f1", "F1-Score")):
        out.append(f"  {name}: {get.get(('macro', 'macro avg', m)) or 0:.4f}")
    fields = sorted(((k, v) for (s, k, _), v in get.items() if s == "field"), key=lambda f: FIELD_ACCURACY_ORDER.index(f[0]))
    if fields:
        out += ["", EVAL_HEADINGS[2], "-" * 50, "(For correctly classified tickets)", ""]
        out += [f"{k}: {v:.4f}" for k, v in fields]
    out += ["", EVAL_HEADINGS[3], "-" * 50,
            f"Parse Error Rate: {get.get(('errors', 'all', 'parse_error_rate')) or 0:.4f}",
            f"Domain Error Rate: {get.get(('errors', 'all', 'domain_error_rate')) or 0:.4f}",
            "", EVAL_HEADINGS[4], "-" * 50]
    if samples is not None:
        srows = samples if isinstance(samples, list) else _rows(samples)
        for flag, title in ((True, "Correct Predictions:"), (False, "Incorrect Predictions:")):
            out += ["", title]
            for r in sorted((r for r in srows if r["type_correct"] == flag), key=lambda r: r["ord"]):
                out += ["", f"Example {r['ord']}:", f"Input: {r['user_input']}",
                        f"True Type: {r['true_type']}", f"Predicted Type: {r['pred_type']}"]
    return "\n".join(out) + "\n"
