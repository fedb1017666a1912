"""Text helpers: codes, paths, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doc_id_of(path: Column) -> Column:
    """File name without its ending."""
    # On the name alone: a pattern over the whole path is tried at each of its characters, for every row.
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=[\s\S])\.[^.]*$", "")


def entity_id_of(path: Column) -> Column:
    """Name of the folder that holds the file."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(path.contains("/") & ~path.endswith("/"), folder).when(path.isNotNull(), "")


def listing_code(sec_code: Column) -> Column:
    """First four characters of a security code, null if it is shorter."""
    return F.when(F.length(sec_code) >= 4, F.substring(sec_code, 1, 4))


def ticker(sec_code: Column) -> Column:
    """Security code without its last character; null or empty gives null."""
    return F.when(
        F.length(sec_code) > 0, F.substring(sec_code, F.lit(1), F.length(sec_code) - 1)
    )


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(value, F.lit("")) for value in values))


def json_text(value: Column) -> Column:
    """JSON text that keeps nulls and non-ASCII characters."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_from_reply(reply: Column) -> Column:
    """The first valid JSON in a reply, as a variant.

    Fenced ``json`` blocks are tried; only without any, text in braces is. A block that
    does not parse is tried again without control characters.
    """
    fenced = F.regexp_extract_all(reply, F.lit(r"(?s)```json(.*?)```"), F.lit(1))
    braces = F.regexp_extract_all(reply, F.lit(r"(?s)\{.*?\}"), F.lit(0))
    blocks = F.when(F.size(fenced) > 0, fenced).otherwise(braces)
    parsed = F.transform(
        blocks,
        lambda block: F.coalesce(
            F.try_parse_json(F.trim(block)),
            F.try_parse_json(F.trim(F.regexp_replace(block, r"[\x00-\x1F\x7F]", ""))),
        ),
    )
    return F.get(F.filter(parsed, lambda value: value.isNotNull()), F.lit(0))


def judgement_fields(reply: Column) -> dict[str, Column]:
    """The three fields of a judgement reply, with their defaults."""
    parsed = json_from_reply(reply)
    return {
        "is_accounting_fraud": F.coalesce(
            F.try_variant_get(parsed, "$.is_accounting_fraud", "boolean"), F.lit(False)
        ),
        "explanation": F.coalesce(
            F.try_variant_get(parsed, "$.explanation", "string"), F.lit("")
        ),
        "company_name": F.coalesce(
            F.try_variant_get(parsed, "$.company_name", "string"), F.lit("")
        ),
    }
