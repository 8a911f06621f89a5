"""Fixed-length token ids with mask, made of native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions.text import lower_tokens

FIRST_FREE_ID = 3


def truncate(tokens, max_tokens: int = V.MAX_TOKENS) -> Column:
    return F.slice(tokens, 1, max_tokens)


def token_id(token: Column, digits: int = 4) -> Column:
    """Id of a token by hashing into 16^digits buckets (no vocabulary needed)."""
    bucket = F.conv(F.substring(F.md5(token), 1, digits), 16, 10).cast("int")
    return bucket + FIRST_FREE_ID


def encode_tokens(df: DataFrame, text: str, max_len: int = V.MAX_TOKENS) -> DataFrame:
    """Add input_ids (start, tokens, end, padding) and attention_mask.

    Tokens are cut to what fits before they are hashed.
    """
    kept = df.withColumn("_tokens", truncate(lower_tokens(text), max_len - 2))
    used = F.size("_tokens") + 2
    body = F.transform("_tokens", lambda t: token_id(t))
    padding = F.array_repeat(F.lit(V.PAD_ID), max_len - used)
    ids = F.concat(F.array(F.lit(V.START_ID)), body, F.array(F.lit(V.END_ID)), padding)
    mask = F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), max_len - used))
    return kept.withColumns({"input_ids": ids, "attention_mask": mask}).drop("_tokens")
