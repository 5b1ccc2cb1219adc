"""Slugs, aliases, names, dates and redaction as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.hashing import DEFAULT_SALT, hmac_hex, sha256_hex


class Redaction(NamedTuple):
    """One redaction rule; rules run in list order, each on the output of the one before.

    ``first`` is what a match can start with. It is tested before the pattern, which
    spares the costly word-boundary test at most positions of a text.
    """

    name: str
    pattern: str
    marker: str
    first: str = "."


# Patterns, markers, block words and their order decide the output text.
# İ, ı, ſ and the Kelvin sign K are the non-ASCII letters that equal ASCII ones without case.
REDACTIONS: tuple[Redaction, ...] = (
    Redaction("card", r"\b(?:\d[ -]*?){13,19}\b", "[REDACTED CREDIT CARD]", r"\d"),
    Redaction(
        "email",
        r"[a-zA-Z0-9_.+\-İıſK]+@[a-zA-Z0-9\-İıſK]+\.[a-zA-Z0-9\-.İıſK]+",
        "[REDACTED EMAIL]",
    ),
    Redaction(
        "phone",
        r"\b(?:\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
        "[REDACTED PHONE]",
        r"[+(\d]",
    ),
    Redaction(
        "employee_id", r"\b(?:EMP|emp)-\d{4,8}\b|\bE\d{5,8}\b", "[REDACTED EMPLOYEE ID]", "[Ee]"
    ),
    Redaction("url", r"https?://[^\s]+", "[REDACTED URL]", "h"),
    Redaction("ip", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[REDACTED IP]", r"\d"),
)
BLOCK_WORDS: tuple[str, ...] = ("confidential", "secret", "restricted")
BLOCKED_TEXT = "[PII SCRUBBED]"
ANONYMOUS_DOMAIN = "example.invalid"
EMPTY_SLUG = "default-slug"
FALLBACK_SLUG_PREFIX = "fallback-"
ALIAS_PREFIX = "user-"


def slugify(value: Column) -> Column:
    """Lower-case ``[a-z0-9-]`` slug; empty and symbol-only values get a stand-in."""
    slug = F.btrim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "-"), F.lit("-"))
    return (
        F.when(value.isNull() | (value == ""), F.lit(EMPTY_SLUG))
        .when(slug == "", F.concat(F.lit(FALLBACK_SLUG_PREFIX), sha256_hex(value, 10)))
        .otherwise(slug)
    )


def stable_alias(value: Column, salt: str = DEFAULT_SALT) -> Column:
    """Keyed pseudonym of a person's name."""
    return F.concat(F.lit(ALIAS_PREFIX), hmac_hex(value, salt))


def non_empty(value: Column) -> Column:
    """The value, or null when it is an empty string."""
    return F.nullif(value, F.lit(""))


def normalize_email(email: Column) -> Column:
    return F.lower(F.regexp_replace(email, r"(?U)^\s+|\s+$", ""))


def member_key(members: Column) -> Column:
    """Order-free key of a member list."""
    return F.array_join(F.array_sort(members), ",")


def upn_local_part(upn: Column) -> Column:
    return F.substring_index(upn, "@", 1)


def safe_attachment_name(path: Column) -> Column:
    """Short path hash plus the sanitised last path component."""
    trimmed = F.regexp_replace(path, r"(?:/+\.?)+$", "")
    last = F.substring_index(trimmed, "/", -1)
    last = F.when(last == ".", F.lit("")).otherwise(last)
    safe = F.regexp_replace(last, "[^a-zA-Z0-9.-]+", "_")
    return F.concat(
        sha256_hex(path, 8), F.lit("_"), F.when(safe == "", F.lit("file")).otherwise(safe)
    )


def is_remote(location: Column) -> Column:
    return location.startswith("http://") | location.startswith("https://")


COMPACT_ISO = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})"
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def iso_to_epoch_ms(text: Column) -> Column:
    """ISO-8601 text to epoch milliseconds, truncated; 0 when missing or unreadable.

    Only whole dates are read, with or without a time; the compact form is one of them.
    Times without an offset are read in the session time zone, which jobs pin to UTC.
    """
    spread = F.regexp_replace(text, COMPACT_ISO, "$1-$2-$3T$4:$5:$6")
    moment = F.when(spread.rlike(ISO), F.try_to_timestamp(spread))
    return F.coalesce(F.unix_millis(moment), F.lit(0).cast("bigint"))


def redact(text: Column, names: Sequence[str] | None = None, rules: Sequence[Redaction] = REDACTIONS) -> Column:
    """Apply the redaction rules (all, or those named) in their fixed order."""
    # Addresses need an @; most texts have none and skip the search. It is looked for in the text
    # as it came: a test of what the rules before made of it would apply them once more.
    may_have_address = text.contains("@")
    for rule in rules:
        if names is None or rule.name in names:
            # (?U): word boundaries, digits and spaces follow Unicode, not ASCII.
            guarded = f"(?U)(?={rule.first})(?:{rule.pattern})"
            cleaned = F.regexp_replace(text, guarded, F.lit(rule.marker))
            text = F.when(may_have_address, cleaned).otherwise(text) if rule.name == "email" else cleaned
            if "@" in rule.marker:
                may_have_address = F.lit(True)
    return text


def has_block_word(text: Column, words: Sequence[str] = BLOCK_WORDS) -> Column:
    lowered = F.lower(text)
    found = lowered.contains(words[0])
    for word in words[1:]:
        found = found | lowered.contains(word)
    return found


def scrub_block_words(text: Column) -> Column:
    """Replace the whole text when it holds a block word."""
    return F.when(has_block_word(text), F.lit(BLOCKED_TEXT)).otherwise(text)


def redact_or_scrub(text: Column) -> Column:
    """Block words first, then every pattern rule; usernames are a separate join."""
    return F.when(has_block_word(text), F.lit(BLOCKED_TEXT)).otherwise(redact(text))
