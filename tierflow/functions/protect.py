"""Protection of sensitive columns: tokens, masks and encryption."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The masked forms u***@e***.com and XXX-XXX-4567.
EMAIL_PATTERN = r"^(.)[^@]*@(.)[^.]*(\..*)$"
EMAIL_MASK = "$1***@$2***$3"
PHONE_MASK = "XXX-XXX-$1"

# What is taken for an address within a text: any signs but separators before the
# ``@``, and a host behind it. A whole value of the form above, with one ``@`` and no
# white space, keeps its exact mask; anything else has each address masked alike.
ONE_ADDRESS = r"^[^\x00-\x20@]+@[^\x00-\x20@]+$"
_LOCAL = r"[^\x00-\x20@<>(),;:\"\[\]\\]"
_HOST = r"[\p{L}\p{N}-]"
EMAIL_IN_TEXT = rf"({_LOCAL}){_LOCAL}*@(\[?[\p{{L}}\p{{N}}]){_HOST}*((?:\.{_HOST}+)*)"
PHONE_PATTERN = r"(?<!\d)(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-](\d{4})(?!\d)"

# Key length in bytes of each cipher.
KEY_BYTES = {"AES-128": 16, "AES-192": 24, "AES-256": 32}


def token(value: Column, salt: str = "") -> Column:
    """Salted SHA-256. A null hashes as the salt alone, so nulls share a token."""
    return F.sha2(F.concat_ws("", value, F.lit(salt)), 256)


def masked_email(value: Column) -> Column:
    whole = F.regexp_replace(value, EMAIL_PATTERN, EMAIL_MASK)
    inside = F.regexp_replace(value, EMAIL_IN_TEXT, EMAIL_MASK)
    return F.when(value.rlike(ONE_ADDRESS) & value.rlike(EMAIL_PATTERN), whole).otherwise(inside)


def masked_phone(value: Column) -> Column:
    return F.regexp_replace(value, PHONE_PATTERN, PHONE_MASK)


def _key(key: bytes | str, algorithm: str) -> Column:
    if algorithm not in KEY_BYTES:
        raise ValueError(f"unknown algorithm {algorithm}, expected one of {list(KEY_BYTES)}")
    raw = key.encode() if isinstance(key, str) else bytes(key)
    if len(raw) != KEY_BYTES[algorithm]:
        raise ValueError(f"{algorithm} needs a key of {KEY_BYTES[algorithm]} bytes")
    return F.lit(bytearray(raw))


def encrypted(value: Column, key: bytes | str, algorithm: str = "AES-256") -> Column:
    """AES-GCM with a fresh random vector per value, as base64 text."""
    return F.base64(F.aes_encrypt(value.cast("string"), _key(key, algorithm)))


def decrypted(
    value: Column, key: bytes | str, algorithm: str = "AES-256", data_type: str = "string"
) -> Column:
    """The value, as text or as the type it had before."""
    text = F.aes_decrypt(F.unbase64(value), _key(key, algorithm)).cast("string")
    return text.cast(data_type)


def hash_column(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """Add ``{column}_token``; the source column stays."""
    return df.withColumn(f"{column}_token", token(F.col(column), salt))


def create_token_mapping(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """Each distinct value of a column with its token."""
    return hash_column(df.select(column).distinct(), column, salt)


def mask_email(df: DataFrame, column: str) -> DataFrame:
    """``user@example.com`` becomes ``u***@e***.com``, alone or within a text."""
    return df.withColumn(column, masked_email(F.col(column)))


def mask_phone(df: DataFrame, column: str) -> DataFrame:
    """``555-123-4567`` becomes ``XXX-XXX-4567``, also with other separators."""
    return df.withColumn(column, masked_phone(F.col(column)))


def encrypt_column(
    df: DataFrame, column: str, key: bytes | str, algorithm: str = "AES-256"
) -> DataFrame:
    return df.withColumn(column, encrypted(F.col(column), key, algorithm))


def decrypt_column(
    df: DataFrame,
    column: str,
    key: bytes | str,
    algorithm: str = "AES-256",
    data_type: str = "string",
) -> DataFrame:
    """Undo ``encrypt_column``; ``data_type`` is the type the column had."""
    return df.withColumn(column, decrypted(F.col(column), key, algorithm, data_type))


def protect_columns(df: DataFrame, policy: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Protect the columns of a table by a policy, in one projection.

    ``{"mail": {"action": "mask_email"}, "name": {"action": "hash", "salt":
    "s"}, "iban": {"action": "encrypt", "key": key}}``. Columns the table lacks
    are ignored. ``hash`` adds ``{column}_token`` and, with ``"drop": True``,
    removes the source column.
    """
    replaced: dict[str, Column] = {}
    dropped: list[str] = []
    for name, rule in policy.items():
        if name not in df.columns:
            continue
        options = {k: v for k, v in rule.items() if k not in ("action", "drop")}
        value = F.col(name)
        match rule["action"]:
            case "hash":
                replaced[f"{name}_token"] = token(value, **options)
                if rule.get("drop"):
                    dropped.append(name)
            case "mask_email":
                replaced[name] = masked_email(value)
            case "mask_phone":
                replaced[name] = masked_phone(value)
            case "encrypt":
                replaced[name] = encrypted(value, **options)
            case "decrypt":
                replaced[name] = decrypted(value, **options)
            case action:
                raise ValueError(f"unknown protection {action!r} for column {name}")
    return df.withColumns(replaced).drop(*dropped)
