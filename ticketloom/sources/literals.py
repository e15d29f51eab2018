"""Literal sample rows (S3 synthetic edge cases, S4 out-of-domain inputs,
S5 challenge set) as small DataFrames in the sample layout.

They are never registered on their own: they join table-derived samples
(U1 union, U2 appended test rows, the challenge partition of the split
writer).  Negative ids keep them apart from table ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed_values import OUT_OF_DOMAIN_ERROR

_SCHEMA = ("source string, sample_id bigint, user_input string, ticket_type string, "
           "title string, description string, severity string, department_impacted string, "
           "service_impacted string, preferred_communication string, "
           "assistance_request string, error string")

_OOD = (None,) * 8 + (OUT_OF_DOMAIN_ERROR,)

# Synthetic edge cases (three samples).
SYNTHETIC = [
    ("URGENT!!! My account was hacked and someone stole $5000!!!",
     ("complaint", "Account security breach - unauthorized transaction",
      "Customer reports account was hacked with $5000 stolen. Urgent security issue requiring immediate attention.",
      "critical", "Security Department", "Online Banking", "phone", None, None)),
    ("I need help refinancing my mortgage to get a better rate",
     ("assistance", "Mortgage refinancing assistance",
      "Customer requesting help with mortgage refinancing to obtain better interest rate.",
      "medium", "Loan Department", "Mortgage Services", "email", "mortgage refinancing", None)),
    ("What's the weather like today?", _OOD),
]

# Out-of-domain inputs appended to the test split (five samples).
OUT_OF_DOMAIN = [
    ("Can you give me a recipe for chocolate cake?", _OOD),
    ("What's the weather forecast for tomorrow?", _OOD),
    ("Tell me a joke about programmers", _OOD),
    ("How do I train a neural network?", _OOD),
    ("What movies are playing this weekend?", _OOD),
]

# Challenge set (eight samples), in order.
CHALLENGE = [
    ("I lost my card and also what's the weather like?",
     ("complaint", "Lost card report", "Customer reported lost card. Non-banking query ignored.",
      "high", "Card Services", "Card Management", "phone", None, None)),
    ("HELP! Someone is using my account RIGHT NOW and making withdrawals!!!",
     ("complaint", "Active fraud - unauthorized withdrawals",
      "URGENT: Customer reports active fraud with ongoing unauthorized withdrawals. Immediate action required.",
      "critical", "Security Department", "Account Security", "phone", None, None)),
    ("I need help consolidating my three loans into one and also setting up automatic payments",
     ("assistance", "Loan consolidation and autopay setup",
      "Customer needs assistance with loan consolidation and automatic payment setup.",
      "medium", "Loan Department", "Loan Services", "email", "loan consolidation", None)),
    ("My statement has a small error but it's been happening for months",
     ("complaint", "Recurring statement errors",
      "Customer reports small but recurring errors in statements over multiple months.",
      "medium", "Account Services", "Statement Services", "email", None, None)),
    ("The ATM took my deposit but didn't credit my account and the app won't let me report it",
     ("complaint", "ATM deposit not credited, app issue",
      "ATM accepted deposit but didn't credit account. Mobile app failing to submit reports.",
      "high", "ATM Services", "ATM Services", "phone", None, None)),
    ("I need help with my credit... score on the video game I'm playing", _OOD),
    ("Card declined",
     ("complaint", "Card declined", "Customer reports card was declined. Further details needed.",
      "medium", "Card Services", "Card Services", "email", None, None)),
    ("My ACH transfer was returned with code R01",
     ("complaint", "ACH transfer returned - R01",
      "Customer's ACH transfer returned with code R01 (Insufficient Funds).",
      "medium", "Transaction Processing", "Transfer Services", "email", None, None)),
]


def _frame(spark: SparkSession, source: str, rows, first_id: int) -> DataFrame:
    data = [(source, first_id - i, text, *ticket) for i, (text, ticket) in enumerate(rows)]
    return spark.createDataFrame(data, _SCHEMA).withColumn("typed_values", F.lit(None).cast("map<string,string>"))


def synthetic_samples(spark: SparkSession) -> DataFrame:
    return _frame(spark, "synthetic", SYNTHETIC, -1)


def ood_samples(spark: SparkSession) -> DataFrame:
    return _frame(spark, "ood", OUT_OF_DOMAIN, -11)


def challenge_samples(spark: SparkSession) -> DataFrame:
    return _frame(spark, "challenge", CHALLENGE, -21)
