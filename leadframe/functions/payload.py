"""Stored model answers: JSON or fenced text, and the fields inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import LINE_BREAKS, _c, first_group, or_empty, py_strip

# The shape of a fenced JSON block and of one quoted field.
FENCED_BLOCK = r"(?is)```(?:\s*json)?\s*(\{.*?\})\s*```"

# Output columns of the two record modes, in file order.
SPEAKER_FIELDS = (
    "Company Name", "Company Domain", "Speaker First name", "Speaker Last name",
    "Speaker position", "Topic of talk", "Description of talk", "Language", "Date and hour",
)
COMPANY_FIELDS = (
    "Company Name", "Company Domain", "Email", "Phone Number", "Address",
    "Hall Number", "Stand Number", "Description", "Linkedin link",
)
LOOSE_FIELDS = ("Email", "Phone Number")
RECORD_FIELDS = {"speaker": SPEAKER_FIELDS, "company": COMPANY_FIELDS}


def strict_json(text) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, or NULL.

    The parser alone stops after the first value and ignores what follows, so
    the text is read as a member that another member must come after.
    """
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), _c(text), F.lit(',"_end_of_text":1}')))
    whole = F.try_variant_get(wrapped, "$._end_of_text", "int") == 1
    return F.when(whole, F.try_variant_get(wrapped, "$.v", "variant"))


def json_or_raw(text) -> Column:
    """Parsed VARIANT, or ``{"raw": text}`` when the text is no JSON."""
    raw = F.to_variant_object(F.struct(_c(text).alias("raw")))
    return F.coalesce(strict_json(text), raw)


def payload_text(data) -> Column:
    """The text to search: the object's ``raw`` member, else its JSON form."""
    data = _c(data)
    raw = F.nullif(F.try_variant_get(data, "$.raw", "string"), F.lit(""))
    plain = F.when(F.schema_of_variant(data) == "STRING", F.try_variant_get(data, "$", "string"))
    return or_empty(F.coalesce(raw, plain, F.to_json(data)))


def unfence(text) -> Column:
    """Body of the first fenced JSON block, or the whole text without one."""
    return F.coalesce(first_group(text, FENCED_BLOCK), _c(text))


def _key(name: str) -> str:
    return '"' + r"\s+".join(name.split()) + r'"\s*:\s*'


def field(payload, name: str) -> Column:
    """Quoted value of a named field, '' when it is missing or not quoted."""
    return py_strip(F.regexp_extract(_c(payload), f'(?iU){_key(name)}"([^"]*)"', 1))


def field_loose(payload, name: str) -> Column:
    """Like :func:`field`, but a bare value up to , } or newline counts too."""
    value = F.regexp_extract(_c(payload), f'(?iU){_key(name)}("[^"]*"|[^,\\n}}]+)', 1)
    return py_strip(F.regexp_replace(value, '^"([^"]*)"$', "$1"))


def record_columns(payload, mode: str) -> list[Column]:
    """One column per field of the record mode."""
    pick = {name: field_loose if name in LOOSE_FIELDS else field for name in RECORD_FIELDS[mode]}
    return [pick[name](payload, name).alias(name) for name in RECORD_FIELDS[mode]]


def join_reasons(reasons, style: str = "comma") -> Column:
    """Reason list as one cell: comma-joined with underscores, or '_'-joined."""
    if style == "comma":
        return F.replace(F.array_join(_c(reasons), ","), F.lit(" "), F.lit("_"))
    return F.array_join(_c(reasons), "_")


def unwrap_closed_label(output, labels, strict: bool = True) -> Column:
    """Model output held to a closed label set.

    The exact label, or the first line when the strict check accepts it.  The
    lenient form returns the first line unchecked.  Nothing usable: Unclear.
    """
    text = py_strip(or_empty(output))
    first = py_strip(F.regexp_extract(text, f"^([^{LINE_BREAKS}]*)", 1))
    fallback = F.when(first.isin(*labels), first).otherwise(F.lit("Unclear")) if strict else \
        F.when(first == "", F.lit("Unclear")).otherwise(first)
    return F.when(text.isin(*labels), text).otherwise(fallback)
