"""Operator 3: personal data, with built-in functions only.

Regular expressions propose spans; validators confirm them (Luhn for cards,
mod-97 for account numbers, octets for addresses, digit counts for telephones);
words nearby raise or lower a span's score. Row-wise: one scan, no shuffle, no
Python.

The four base kinds (email, ip, card, phone) are reported whenever their
validator holds. The method adds account numbers (``iban``) and, where the
context speaks for them, national telephone numbers (``national``) and social
security numbers (``ssn``); an added span never overlaps a base span.

Defined cases: a null or empty text has no spans. Null ids and repeated rows are
carried through row by row. Further columns are ignored. Texts of any length are
searched whole, in linear time (see ``spans``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .spans import count_kind, digest, find, without_overlap

# Base patterns. Same matches as the plain forms; see ``spans`` for the shape.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"       # shorter runs fail the digit count anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Added patterns.
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
        r"(?![A-Za-z0-9])")
NATIONAL = (r"(?<![0-9+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
            r"(?![0-9-])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national", "ssn")

# Score of a confirmed span before its context is read.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "national": 0.4, "ssn": 0.4}
LIFT, THRESHOLD = 0.2, 0.55
CONTEXT = {
    "email": "mail|contact|kontakt|contacto|courriel|correo|write to",
    "ip": "\\bip\\b|address|adresse|host|server|login|client",
    "card": "card|carte|karte|tarjeta|visa|master|credit|payment|zahlung|pago",
    "phone": "phone|tel\\b|telef|mobile|cell|call|fax|handy|portable|m[oó]vil",
    "iban": "iban|account|konto|compte|cuenta|bank|banque",
    "national": "phone|tel\\b|telef|mobile|cell|call|fax",
    "ssn": "\\bssn\\b|social security|tax id",
}
AGAINST = "version|order no|invoice|serial|part no|isbn|example only"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def octets_hold(value: Column) -> Column:
    def small(part):
        z = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(z) < 3) | ((F.length(z) == 3) & (z <= "255"))
    return F.forall(F.split(value, "\\."), small)


def card_holds(value: Column) -> Column:
    d = digits_of(value)
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def mod97_holds(value: Column) -> Column:
    """The account number, its first four characters moved to the end, letters as
    10..35, leaves 1 when divided by 97."""
    v = F.regexp_replace(value, "\\x20", "")
    turned = F.concat(F.substring(v, 5, 100), F.substring(v, 1, 4))

    def step(acc, c):
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)
    return F.length(v).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def ssn_holds(value: Column) -> Column:
    return (~value.rlike("^(000|666|9)")) & (~value.rlike("-00-")) & (~value.rlike("-0000$"))


def found(text: Column) -> Column:
    """Confirmed and scored spans: base kinds as listed then by start, then the added kinds."""
    t = F.coalesce(text, F.lit(""))
    proposals = {
        "email": (EMAIL, F.contains(t, F.lit("@")), lambda v: F.lit(True)),
        "ip": (IP, None, octets_hold),
        "card": (CARD, None, card_holds),
        "phone": (PHONE, F.contains(t, F.lit("+")), lambda v: F.length(digits_of(v)).between(9, 15)),
        "iban": (IBAN, None, mod97_holds),
        "national": (NATIONAL, None, lambda v: F.lit(True)),
        "ssn": (SSN, F.contains(t, F.lit("-")), ssn_holds),
    }

    def scored(kind):
        pattern, hint, holds = proposals[kind]
        spans = F.filter(find(t, kind, pattern, hint), lambda s: holds(s["value"]))

        def score(s):
            near = F.lower(s["context"])
            return (F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), LIFT).otherwise(0.0)
                    - F.when(near.rlike(AGAINST), LIFT).otherwise(0.0))
        return F.transform(spans, lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.round(score(s), 2).alias("score")))

    return (F.concat(*[scored(k) for k in BASE_KINDS]),
            F.concat(*[F.filter(scored(k), lambda s: s["score"] >= THRESHOLD) for k in ADDED_KINDS]))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``spans`` (base and added),
    arrays of (kind, start, end, score); places in code points, end exclusive."""
    base, added = found(F.col("text"))
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", base.alias("base"), added.alias("added"))
            .select("doc_id", "base",
                    F.concat("base", without_overlap(F.col("added"), F.col("base"))).alias("spans")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pii_spans(read_table(spark, sf_dir, "documents"))
    base, spans = F.col("base"), F.col("spans")
    return s.select(
        "doc_id", *[count_kind(base, k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(digest(base), 256).alias("base_sha256"), digest(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda x: x["score"])).alias("max_score"))
