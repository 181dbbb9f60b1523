"""Landed CRM and sales-tool API pages to flat tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import or_empty, parse_timestamp
from .joins import pinned

# Output columns in file order, with their source names.
COMPANY_COLUMNS = (
    ("name", "name"), ("domain", "primary_domain"),
    ("organization_revenue", "organization_revenue"), ("organization_city", "organization_city"),
    ("organization_country", "organization_country"), ("website_url", "website_url"),
    ("linkedin_url", "linkedin_url"), ("twitter_url", "twitter_url"),
    ("facebook_url", "facebook_url"), ("founded_year", "founded_year"),
    ("market_cap", "market_cap"), ("phone", "sanitized_phone"),
    ("alexa_ranking", "alexa_ranking"),
)
CONTACT_COLUMNS = (
    ("first_name", "first_name"), ("last_name", "last_name"),
    ("organization_name", "organization.name"), ("title", "title"),
    ("linkedin_url", "linkedin_url"), ("city", "city"), ("country", "country"),
    ("email", "email"), ("phone", "sanitized_phone"),
)
DEAL_COLUMNS = (
    ("id", "id"), ("title", "title"), ("value", "value"), ("currency", "currency"),
    ("status", "status"), ("add_time", "add_time"), ("update_time", "update_time"),
    ("stage_id", "stage_id"), ("pipeline_id", "pipeline_id"), ("owner_name", "owner_name"),
    ("person_name", "person_id.name"), ("org_name", "org_id.name"),
    ("person_email", "person_id.email[0].value"), ("org_address", "org_id.address"),
    ("lost_reason", "lost_reason"), ("close_time", "close_time"), ("won_time", "won_time"),
    ("first_won_time", "first_won_time"),
)

def _array(column: str, element: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast(f"array<{element}>"))


def _present(df: DataFrame, item: str, pairs) -> list[Column]:
    """Struct members by name; a member the schema lacks becomes ''."""
    known = {f.name: f.dataType for f in df.schema[item].dataType.fields}
    out = []
    for name, source in pairs:
        head, _, rest = source.partition(".")
        nested = rest and head in known and rest in known[head].names
        exists = head in known and (not rest or nested)
        value = F.col(f"{item}.{source}").cast("string") if exists else F.lit("")
        out.append(or_empty(value).alias(name))
    return out


def flatten_companies(pages: DataFrame, accounts: str = "accounts",
                      organizations: str = "organizations") -> DataFrame:
    """Both record lists of every page as one company table."""
    element = pages.schema[accounts].dataType.elementType.simpleString()
    rows = pages.select(F.explode(F.concat(
        _array(accounts, element), _array(organizations, element))).alias("item"))
    return rows.select(*_present(rows, "item", COMPANY_COLUMNS))


def flatten_contacts(pages: DataFrame, contacts: str = "contacts") -> DataFrame:
    """Contacts with the columns of an e-mail lookup that has not run yet."""
    rows = pages.select(F.explode(contacts).alias("item"))
    return rows.select(
        *_present(rows, "item", CONTACT_COLUMNS),
        F.lit(-1).alias("confidence score"),
        F.lit("not_in_hunter").alias("mail_status"),
    )


def _landed(pages: DataFrame, payload: str) -> DataFrame:
    """Pages with their answer read once, and whether the service called it a success."""
    read = pinned(pages, "_page", F.try_parse_json(payload))
    success = F.coalesce(F.try_variant_get("_page", "$.success", "string") == "true", F.lit(False))
    return read.withColumn("_success", success)


def flatten_deals(pages: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Deals of every successful page, behind the columns of the page to ``keep``.

    A failed page brings none; what failed is listed by :func:`failed_pages`.  A
    person or organisation may be an object or a bare number.  Paths into a
    number are NULL, so both shapes share one projection.
    """
    deals = _landed(pages, payload).where("_success").select(*keep, F.explode(
        F.try_variant_get("_page", "$.data", "array<variant>")).alias("deal"))
    return deals.select(*keep, *[
        F.try_variant_get("deal", f"$.{source}", "string").alias(name)
        for name, source in DEAL_COLUMNS])


def failed_pages(pages: DataFrame, load: str, payload: str = "payload") -> DataFrame:
    """Pages and failed pages of each load."""
    return _landed(pages, payload).groupBy(load).agg(
        F.count("*").alias("pages"), F.count_if(~F.col("_success")).alias("failed"))


def write_loads(records: DataFrame, announced: DataFrame, load: str, path: str, mode: str = "append") -> DataFrame:
    """Write records and count them on the way: ``load, announced, found, complete``, one row for each load.

    ``announced`` has one row ``load, announced`` for each run against the
    service, as people start them; every one is a counter of the write itself, so
    no record is read twice.  Records of other loads are written as well, and
    counted in a row without ``announced``, where there are any.
    """
    spark = records.sparkSession
    told = [(r[0], r[1]) for r in announced.select(load, "announced").collect()]
    seen = Observation()
    known = [F.count_if(F.col(load).eqNullSafe(F.lit(value))).alias(f"n{i}") for i, (value, _) in enumerate(told)]
    records.observe(seen, F.count("*").alias("every"), *known).write.mode(mode).parquet(path)
    got = seen.get
    rows = [(value, total, got[f"n{i}"]) for i, (value, total) in enumerate(told)]
    other = got["every"] - sum(n for _, _, n in rows)
    schema = T.StructType([announced.schema[load], T.StructField("announced", T.LongType()), T.StructField("found", T.LongType())])
    counted = spark.createDataFrame(rows + ([(None, None, other)] if other else []), schema)
    return counted.withColumn("complete", F.col("found") >= F.col("announced"))


def recent_prospects(prospects: DataFrame, cutoff: str, contacted: str = "last_contacted"
                     ) -> DataFrame:
    """Prospects contacted at or after the cutoff; bad timestamps drop out."""
    return prospects.withColumn(contacted, parse_timestamp(contacted)) \
        .where(F.col(contacted) >= F.to_timestamp(F.lit(cutoff), "yyyy-MM-dd'T'HH:mm:ssZ"))


def union_prospects(pages: list[DataFrame], cutoff: str) -> DataFrame:
    """Outer union of pages with different columns, recent prospects only."""
    recent = [recent_prospects(page, cutoff) for page in pages]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), recent)


def _members(pages: DataFrame, payload: str) -> Column:
    return F.try_variant_get(F.try_parse_json(payload), "$", "array<map<string,variant>>")


def widen_prospects(pages: DataFrame, columns, payload: str = "payload") -> DataFrame:
    """Landed JSON record lists as one wide string table with the named columns."""
    records = pages.select(F.explode(_members(pages, payload)).alias("rec"))
    return records.select(*[
        F.try_variant_get(F.try_element_at("rec", F.lit(c)), "$", "string").alias(c)
        for c in columns])


def prospect_members(pages: DataFrame, page: str, payload: str = "payload") -> DataFrame:
    """``page, record, name, value`` for every member of every record, whatever its name."""
    records = pages.select(page, F.posexplode(_members(pages, payload)).alias("record", "rec"))
    return records.select(page, "record", F.explode("rec").alias("name", "_value")) \
        .select(page, "record", "name", F.try_variant_get("_value", "$", "string").alias("value"))


_SEARCHED = ("title", "seniority", "department", "city", "organization_country", "label", "organization_name", "industry")
_TAG_MARK = "\x1f"


def _key(df: DataFrame, column: str) -> Column:
    """The stored key of a column, else the same made on the spot."""
    return F.col(f"{column}_key") if f"{column}_key" in df.columns else F.lower(column)


def _any_of(key: Column, values) -> Column:
    return key.isin(*[v.lower() for v in values])


def _tag_key(tags: str) -> Column:
    """All tags in lower case, each between marks, so that one of them is a substring."""
    clean = F.transform(tags, lambda t: F.translate(F.lower(t), _TAG_MARK, " "))
    return F.concat(F.lit(_TAG_MARK), F.array_join(clean, _TAG_MARK), F.lit(_TAG_MARK))


def write_search_table(people: DataFrame, path: str, order=("organization_country", "industry", "seniority")) -> DataFrame:
    """People as a table that searches can skip through; the table read back.

    Every searched column gets a key in lower case.  Rows are ranged and sorted
    by the keys of ``order``, so that statistics of row groups exclude most of
    them, and the other keys have Parquet Bloom filters.
    """
    present = [c for c in _SEARCHED if c in people.columns]
    keyed = people.select("*", *[F.lower(c).alias(f"{c}_key") for c in present],
                          *([_tag_key("keyword_tags").alias("keyword_tags_key")] if "keyword_tags" in people.columns else []))
    sort = [f"{c}_key" for c in order if c in present]
    writer = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort).write
    for c in present:
        if c != "title":  # titles are searched by parts of them
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}_key", "true")
    writer.parquet(path)
    return people.sparkSession.read.parquet(path)


def people_search(people: DataFrame, titles=(), not_titles=(), seniorities=(), departments=(),
                  locations=(), organization_locations=(), email_status=None, employees=None,
                  prospected=None, labels=(), organizations=(), keyword_tags=(), industries=()
                  ) -> DataFrame:
    """People matching every given criterion.

    E-mail status, employees and the prospected flag are plain comparisons and
    reach the file scan.  Lists and title parts ignore case: on a table of
    :func:`write_search_table` they are plain comparisons with its keys and
    reach the scan too, on any other table they are compared after reading.  Title
    lists match as substrings, the other lists exactly.  The keys are not part of the result.
    """
    out = people
    title = _key(people, "title") if titles or not_titles else None
    if title is not None and "title_key" not in people.columns:
        title = F.lower(or_empty("title"))
    for values, keep in ((titles, True), (not_titles, False)):
        if values:
            hit = reduce(lambda a, b: a | b, [title.contains(v.lower()) for v in values])
            out = out.where(hit if keep else ~hit | title.isNull())
    exact = (("seniority", seniorities), ("department", departments), ("city", locations),
             ("organization_country", organization_locations), ("label", labels),
             ("organization_name", organizations), ("industry", industries))
    for column, values in exact:
        if values:
            out = out.where(_any_of(_key(people, column), values))
    if keyword_tags:
        tags = F.col("keyword_tags_key") if "keyword_tags_key" in people.columns else _tag_key("keyword_tags")
        marked = [f"{_TAG_MARK}{t.lower().replace(_TAG_MARK, ' ')}{_TAG_MARK}" for t in keyword_tags]
        out = out.where(reduce(lambda a, b: a | b, [tags.contains(m) for m in marked]))
    if email_status is not None:
        out = out.where(F.col("email_status") == email_status)
    if employees is not None:
        out = out.where(F.col("employees").between(*employees))
    if prospected is not None:
        out = out.where(F.col("prospected") == prospected)
    return out.drop(*[f"{c}_key" for c in (*_SEARCHED, "keyword_tags")])


def company_search(companies: DataFrame, employee_ranges=(), locations=(), labels=()) -> DataFrame:
    """Companies in any of the size ranges, any of the locations and labels."""
    out = companies
    if employee_ranges:
        out = out.where(reduce(lambda a, b: a | b, [
            F.col("employees").between(lo, hi) for lo, hi in employee_ranges]))
    if locations:
        out = out.where(_any_of(_key(companies, "organization_country"), locations))
    if labels:
        out = out.where(_any_of(_key(companies, "label"), labels))
    return out
