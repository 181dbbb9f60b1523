"""Attributes of tags, and the structured data that pages embed: JSON-LD and microdata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, collapse_ws, py_strip

# One attribute after the other: a quoted value is consumed whole, so what looks like an attribute inside it is none.
_ATTRIBUTE = r"""[^\s=/>"']++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>]++))?+"""
_TAG_REST = r"""(?:[^<>"']++|"[^"]*"|'[^']*')*+"""
_JSON_LD = rf"""(?is)<script[\s/](?=[^>]*application/ld\+json){_TAG_REST}>(.*?)</script"""
_ITEM = rf"""(?is)<[a-z][a-z0-9]*[\s/](?=[^>]*\bitemprop\b){_TAG_REST}>[^<]*"""

# Names of the public schema vocabulary.
ADDRESS_PARTS = ("streetAddress", "postalCode", "addressLocality", "addressRegion", "addressCountry")
NOTE_FIELDS = ("legalName", "slogan", "foundingDate", "vatID", "openingHours")


def attributes(tag) -> Column:
    """``name, value`` of every attribute of one tag, in order; names in lower case, a bare attribute has value ''.

    ``tag`` may go on behind the tag.
    """
    inside = F.regexp_extract(_c(tag), rf"(?is)^<[a-z][a-z0-9]*({_TAG_REST})", 1)

    def pair(text: Column) -> Column:
        value = F.regexp_extract(text, r"(?s)=\s*(.*)$", 1)
        return F.struct(F.lower(F.regexp_extract(text, r"^[^\s=]+", 0)).alias("name"),
                        F.when(value.rlike(r"(?s)^[\"'].*[\"']$"), F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value).alias("value"))

    return F.transform(F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(0)), pair)


def attribute(tag_attributes: Column, name: str) -> Column:
    """Value of the first attribute of that name, NULL if there is none."""
    return F.get(F.filter(tag_attributes, lambda a: a["name"] == name), F.lit(0))["value"]


def meta_content(html, name: str) -> Column:
    """Content of the first ``<meta>`` of that name, whatever the order of its attributes; '' if there is none."""
    tags = F.regexp_extract_all(_c(html), F.lit(rf"(?is)<meta[\s/]{_TAG_REST}>"), F.lit(0))
    named = F.filter(F.transform(tags, attributes), lambda a: F.lower(py_strip(attribute(a, "name"))) == name)
    return F.coalesce(F.get(F.transform(named, lambda a: attribute(a, "content")), F.lit(0)), F.when(_c(html).isNotNull(), F.lit("")))


def json_ld(html) -> Column:
    """Nodes of all readable JSON-LD blocks: a block's object, the members of its list or of its ``@graph``."""
    none = F.array().cast("array<variant>")

    def nodes(text: Column) -> Column:
        root = F.try_parse_json(py_strip(text))
        several = [F.coalesce(F.try_variant_get(root, path, "array<variant>"), none) for path in ("$", "$['@graph']")]
        return F.concat(F.when(F.schema_of_variant(root).startswith("OBJECT"), F.array(root)).otherwise(none), *several)

    blocks = F.regexp_extract_all(_c(html), F.lit(_JSON_LD), F.lit(1))
    return F.when(_c(html).contains("ld+json"), F.flatten(F.transform(blocks, nodes))).otherwise(none)


def microdata(html) -> Column:
    """``name, value`` of every element with ``itemprop``: its content attribute, or the text it starts with."""
    def item(found: Column) -> Column:
        own = attributes(found)
        text = F.regexp_extract(found, r"(?s)>([^<>]*)$", 1)
        return F.struct(attribute(own, "itemprop").alias("name"), collapse_ws(F.coalesce(attribute(own, "content"), text)).alias("value"))

    none = F.array().cast("array<struct<name:string,value:string>>")
    return F.when(_c(html).contains("itemprop"), F.transform(F.regexp_extract_all(_c(html), F.lit(_ITEM), F.lit(0)), item)).otherwise(none)


def _text(value: Column, path: str) -> Column:
    """A scalar of a variant as clean text; NULL for objects, lists and blanks."""
    found = F.try_variant_get(value, path, "variant")
    plain = ~F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    return F.nullif(F.when(plain, collapse_ws(F.try_variant_get(value, path, "string"))), F.lit(""))


def _joined_address(part) -> Column:
    """Street, code and town, region, country; ``part`` gives the value of a name or NULL."""
    town = F.nullif(F.concat_ws(" ", part("postalCode"), part("addressLocality")), F.lit(""))
    return F.nullif(F.concat_ws(", ", part("streetAddress"), town, part("addressRegion"), part("addressCountry")), F.lit(""))


def first_address(nodes: Column, items: Column) -> Column:
    """First address of the JSON-LD nodes, else of the microdata, on one line; NULL if the page has none."""
    def of(node: Column) -> Column:
        def part(name: str) -> Column:
            return F.coalesce(_text(node, f"$.address.{name}"), _text(node, f"$.address[0].{name}"),
                              _text(node, f"$.address.{name}.name"))
        return F.coalesce(_text(node, "$.address"), _joined_address(part))

    def item(name: str) -> Column:
        return F.nullif(F.get(F.filter(items, lambda i: i["name"] == name), F.lit(0))["value"], F.lit(""))

    listed = F.filter(F.transform(nodes, of), lambda a: a.isNotNull())
    return F.coalesce(F.get(listed, F.lit(0)), _joined_address(item))


def node_texts(nodes: Column, path: str) -> Column:
    """The values at a path of all nodes, where they are plain."""
    return F.filter(F.transform(nodes, lambda n: _text(n, path)), lambda v: v.isNotNull())


def notes(nodes: Column) -> Column:
    """Further facts as ``name: value``, the first of each name; NULL without any."""
    said = [F.get(node_texts(nodes, f"$.{name}"), F.lit(0)) for name in NOTE_FIELDS]
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in zip(NOTE_FIELDS, said)]
    return F.nullif(F.concat_ws("; ", *lines), F.lit(""))
