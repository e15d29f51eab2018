"""Fixed values.

Every value in this module must equal the behaviour being reproduced
(spellings, word lists, prompt texts, defaults, labels).  They are stated
plainly and in their natural order; nothing here is derived.
"""

# ---------------------------------------------------------------------------
# Raw ticket JSON keys (Title-Case, with spaces).
RAW_KEYS = [
    "Ticket Type",
    "Title",
    "Description",
    "Severity",
    "Department Impacted",
    "Service Impacted",
    "Preferred Communication",
    "Assistance Request",
]

# Canonical ticket fields, in record order.
TICKET_FIELDS = [
    "ticket_type",
    "title",
    "description",
    "severity",
    "department_impacted",
    "service_impacted",
    "preferred_communication",
]
OPTIONAL_FIELD = "assistance_request"

# Ticket type spellings after lower-case + strip.
TICKET_TYPE_MAPPING = {
    "complaint": "complaint",
    "complaints": "complaint",
    "complaining": "complaint",
    "compla intimation": "complaint",
    "inquiry": "inquiry",
    "enquiray": "inquiry",
    "assistance": "assistance",
    "request for assistance": "assistance",
}
TICKET_TYPE_DEFAULT = "complaint"

# Severity spellings.  ' medium' and 'High' can never match
# after lower-case + strip; they are kept because the mapping has them.
SEVERITY_MAPPING = {
    "low": "low",
    "medium": "medium",
    " medium": "medium",
    "high": "high",
    "High": "high",
    "critical": "critical",
}
SEVERITY_DEFAULT = "medium"

# Communication clean-up.
COMMUNICATION_NOT_SPECIFIED = "not specified"
COMMUNICATION_REPLACEMENT = "email"

# Standard ticket types and the high-severity set.
STANDARD_TYPES = ["complaint", "inquiry", "assistance"]
HIGH_SEVERITIES = ["high", "critical"]

# Defaults of the alternative loader, used only when the key
# is absent from the JSON object.
LOADER_DEFAULTS = {
    "Ticket Type": "inquiry",
    "Title": "",
    "Description": "",
    "Severity": "medium",
    "Department Impacted": "Customer Service",
    "Service Impacted": "General Banking",
    "Preferred Communication": "email",
}
LOADER_ASSISTANCE_REQUEST = "general assistance"

# Defaults of the training-record builder, used only when the
# whole column is missing from the frame.
RECORD_COLUMN_DEFAULTS = {
    "Title": "",
    "Description": "",
    "Department Impacted": "Customer Service",
    "Service Impacted": "General Banking",
    "Preferred Communication": "email",
}

# Assistance request derived from the description, in
# priority order (case-insensitive substring), then the fallback.
ASSISTANCE_KEYWORDS = [
    ("loan", "loan assistance"),
    ("mortgage", "mortgage assistance"),
    ("account", "account assistance"),
]
ASSISTANCE_FALLBACK = "general assistance"

# Stopwords for the per-type keyword lists (48 words).
TYPE_STOPWORDS = [
    "i", "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "is", "are", "was", "were", "been", "have",
    "has", "had", "do", "does", "did", "will", "would", "could", "should",
    "may", "might", "must", "can", "my", "your", "me", "you", "it", "this",
    "that", "what", "how", "when", "where", "why", "who",
]
# Stopwords for the high-severity keyword list (12 words).
HIGH_SEVERITY_STOPWORDS = [
    "i", "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
]
# Keyword list sizes.
TYPE_KEYWORDS_TOP = 20
HIGH_SEVERITY_KEYWORDS_TOP = 15
KEYWORDS_KEEP = 10
KEYWORDS_MIN_LEN = 3
KEYWORDS_PRINTED = 5

# Quality-report thresholds.
SHORT_INPUT_CHARS = 10
TOP_DEPARTMENTS = 10
HISTOGRAM_BINS = 50

# Sampling and splitting defaults.
SEED = 42
BALANCE_TARGET = 5000
SPLIT_RATIOS = (0.8, 0.1, 0.1)
TRAIN_RATIO = 0.9
VALIDATION_SHARE_OF_TEST = 0.5
RATIO_TOLERANCE = 0.001

# Out-of-domain marker.
OUT_OF_DOMAIN_ERROR = "Request outside banking domain"

# Outcome labels of the evaluation.
LABEL_ERROR = "error"
LABEL_OUT_OF_DOMAIN = "out_of_domain"
LABEL_DOMAIN_ERROR = "domain_error"
LABEL_UNKNOWN = "unknown"
LABEL_PARSE_ERROR = "parse_error"
LABEL_JSON_ERROR = "json_error"

# Reply parsing.
INST_CLOSE = "[/INST]"
REPLY_NO_JSON_ERROR = "Failed to parse response"
REPLY_BAD_JSON_PREFIX = "JSON decode error: "

# Fields compared in the evaluation, in report order.
COMPARED_FIELDS = [
    "severity",
    "department_impacted",
    "service_impacted",
    "preferred_communication",
]
FIELD_ACCURACY_ORDER = COMPARED_FIELDS + ["assistance_request"]

# Token budgets.
EVAL_MAX_TOKENS = 512
TRAIN_MAX_TOKENS = 2048

# System prompt used to build training records.
TRAINING_SYSTEM_PROMPT = """You are a banking customer service ticket classification and filling assistant. Your role is to:
1. Analyze customer inputs and extract relevant information.
2. Fill ticket fields accurately based on the customer's request.
3. Stay strictly within the banking and financial services domain.
4. Reject any requests outside of banking support.

You must ONLY respond with a valid JSON object containing the ticket fields. Do not provide any other information or engage in conversation.

Required fields:
- ticket_type: "complaint", "inquiry", or "assistance"
- title: Brief summary of the issue
- description: Detailed description
- severity: "low", "medium", "high", or "critical"
- department_impacted: The bank department affected
- service_impacted: The specific service affected
- preferred_communication: "email", "phone", "chat", or "in-person"
- assistance_request: (ONLY if ticket_type is "assistance") - specific assistance needed

If the request is not related to banking, respond with: {"error": "Request outside banking domain"}"""

# System prompt used at evaluation time.
EVAL_SYSTEM_PROMPT = """You are a banking customer service ticket classification and filling assistant. Your role is to:
1. Analyze customer inputs and extract relevant information
2. Fill ticket fields accurately based on the customer's request
3. Stay strictly within banking and financial services domain
4. Reject any requests outside of banking support

You must ONLY respond with a valid JSON object containing the ticket fields. Do not provide any other information or engage in conversation.

Required fields:
- ticket_type: "complaint", "inquiry", or "assistance"
- title: Brief summary of the issue
- description: Detailed description
- severity: "low", "medium", "high", or "critical"
- department_impacted: The bank department affected
- service_impacted: The specific service affected
- preferred_communication: "email", "phone", "chat", or "in-person"
- assistance_request: (ONLY if ticket_type is "assistance") - specific assistance needed

If the request is not related to banking, respond with: {"error": "Request outside banking domain"}"""

# Inference prompt layout ({system}, {user}).
EVAL_PROMPT_TEMPLATE = "<s>[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{user} [/INST]"

# pandas' default spellings of a missing CSV cell.
CSV_NULL_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Report layout (titles, headings, issue lines).
QUALITY_REPORT_TITLE = "=== Banking Ticket Data Quality Report ==="
QUALITY_HEADINGS = {
    "missing": "Missing Values:",
    "ticket_type": "Ticket Type Distribution:",
    "severity": "Severity Distribution:",
    "department": "Department Distribution:",
    "input_length": "Input Length Analysis:",
    "issues": "Potential Data Quality Issues:",
}
QUALITY_ISSUE_LINES = {
    "very_short_inputs": "  - {n} records with very short inputs (<10 chars)",
    "duplicate_inputs": "  - {n} duplicate inputs found",
    "non_standard_types": "  - {n} records with non-standard ticket types",
}
EVAL_REPORT_TITLE = "=== Banking Ticket Model Evaluation Report ==="
EVAL_HEADINGS = [
    "1. OVERALL PERFORMANCE",
    "2. CLASSIFICATION REPORT",
    "3. FIELD-LEVEL ACCURACY",
    "4. ERROR ANALYSIS",
    "5. SAMPLE PREDICTIONS",
]
