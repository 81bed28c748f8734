"""Personal data: masks inside text, deterministic tokens, erasure, and
column-level entitled views (L14-L16). Semantics are our definition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import broadcast_if_small

# Mask patterns (Java regex, also valid RE2) applied in this
# order (e-mail first, since addresses contain digits and dots), each match
# replaced by its placeholder. A card match is replaced only if it is one, see
# :func:`is_card`.
PII_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}", "<phone>"),
    ("national", r"\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}", "<phone>"),
    # groups of a card's digits, or a whole run of digits
    ("card", r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d+|\d{4}[ -]\d{6}[ -]\d{5}|\d+", "<card>"),
    ("ip", r"(?:\d{1,3}\.){3}\d{1,3}", "<ip>"),
)
# A literal every match of the pattern contains: texts without it skip the
# regex (a substring search instead of a backtracking scan of every position).
_REQUIRED = {"email": "@", "phone": "+", "national": "(", "ip": "."}
#: Stands around candidates while they are told apart; no text holds it.
_EDGE = "\uf8ff\ue000\uf8ff"


def is_card(candidate: Column) -> Column:
    """13 to 19 digits, with blanks or dashes or without, whose last one checks."""
    digits = F.regexp_replace(candidate, "[ -]", "")
    return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _mask_cards(c: Column, pattern: str, repl: str) -> Column:
    """Candidates are put between edges, so cutting there leaves them at odd places."""
    pieces = F.split(F.regexp_replace(c, f"({pattern})", f"{_EDGE}$1{_EDGE}"), _EDGE)
    chosen = F.transform(pieces, lambda x, i: F.when((i % 2 == 1) & is_card(x), F.lit(repl)).otherwise(x))
    return F.when(c.rlike(r"\d{4}"), F.array_join(chosen, "")).otherwise(c)


def mask_text(col: str | Column, kinds: Sequence[str] | None = None) -> Column:
    """Replace e-mails, phones (international, or with an area code in
    parentheses), card numbers (grouped or not, with a valid check digit) and
    IPv4 addresses inside free text with placeholders; whole text, JVM-side."""
    c = F.col(col) if isinstance(col, str) else col
    for kind, pattern, repl in PII_PATTERNS:
        if kinds is None or kind in kinds:
            if kind == "card":
                c = _mask_cards(c, pattern, repl)
                continue
            replaced = F.regexp_replace(c, pattern, repl)
            lit = _REQUIRED.get(kind)
            c = F.when(c.contains(lit), replaced).otherwise(c) if lit else replaced
    return c


def mask(df: DataFrame, columns: Sequence[str], kinds: Sequence[str] | None = None) -> DataFrame:
    """L14 on whole columns: one projection per pattern, so every regex runs
    once per value (Catalyst keeps non-trivial projections apart)."""
    for kind, _, _ in PII_PATTERNS:
        if kinds is None or kind in kinds:
            df = df.withColumns({c: mask_text(c, [kind]) for c in columns})
    return df


def token(col: str | Column, salt: str) -> Column:
    """Deterministic, joinable token: ``sha256(salt || value)`` in hex. An empty
    salt is refused: unsalted hashes of names can be guessed."""
    if not salt:
        raise ValueError("a token needs a salt")
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def tokenise(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Tagged identifier columns replaced by their tokens."""
    return df.withColumns({c: token(c, salt) for c in columns})


def erase(df: DataFrame, subjects: DataFrame, key: str | Sequence[str],
          subject_key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` not belonging to any subject of the request list.
    The subject list is broadcast only when proven small (size-checked)."""
    k = [key] if isinstance(key, str) else list(key)
    sk = k if subject_key is None else ([subject_key] if isinstance(subject_key, str) else list(subject_key))
    subj = subjects.select(*[F.col(s).alias(t) for s, t in zip(sk, k)]).distinct()
    return df.join(broadcast_if_small(subj), k, "left_anti")


def erasure_audit(df: DataFrame, subjects: DataFrame, key: str, request_id: str, now) -> DataFrame:
    """L15 audit: one row per request with the number of rows removed."""
    removed = df.join(subjects.select(F.col(key)).distinct(), key, "left_semi")
    return removed.agg(F.count(F.lit(1)).alias("rows_removed")).select(
        F.lit(request_id).alias("request_id"), F.lit(now).cast("timestamp").alias("erased_at"),
        "rows_removed")


def entitled_view(df: DataFrame, tags: Mapping[str, str], entitlements: Sequence[str],
                  salt: str, hidden: Sequence[str] = ("restricted",)) -> DataFrame:
    """A projection chosen by the reader's entitlements: a tagged column
    is clear when its tag is entitled, absent when its tag is in ``hidden``
    and not entitled, and tokenised otherwise. Untagged columns are clear.
    An empty salt is refused."""
    if not salt:
        raise ValueError("entitled_view needs a salt")
    out = []
    for c in df.columns:
        tag = tags.get(c)
        if tag is None or tag in entitlements:
            out.append(F.col(c))
        elif tag in hidden:
            continue
        else:
            out.append(token(c, salt).alias(c))
    return df.select(*out)
