"""Export documents: version gate, contract check and flattening into a workspace.

A document is one JSON text with ``users``, ``teams`` and ``direct_channels``. Large
exports come as many documents; their sections follow one another in document order.

Outer objects (teams, channels, direct channels) are taken apart as text, one level at a
time; only users, posts and the plain fields of outer objects become variants. The size
bound of a variant therefore holds for one user or post, never for a document or channel.
An item of an outer list that is a text counts as an object if it reads as one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.sequence import global_index
from chatloom.plans.staging import stage, together
from chatloom.plans.workspace import ATTACHMENTS, Workspace


class SourceError(RuntimeError):
    """The source cannot be read."""


class ContractError(ValueError):
    """The source can be read but breaks the contract."""


class Field(NamedTuple):
    kind: str  # text, email, count, flag, texts, items
    required: bool = False
    nullable: bool = False


# The document contract.
ATTACHMENT = {"name": Field("text", True), "path": Field("text", True), "url": Field("text", nullable=True)}
POST = {
    "username": Field("text", True),
    "message": Field("text", True),
    "timestamp_ms": Field("count", True),
    "id": Field("text", nullable=True),
    "parent_id": Field("text", nullable=True),
    "attachments": Field("items"),
}
CHANNEL = {
    "name": Field("text", True),
    "display_name": Field("text", True),
    "is_private": Field("flag"),
    "posts": Field("items"),
    "members": Field("texts"),
    "owners": Field("texts"),
}
TEAM = {
    "name": Field("text", True),
    "display_name": Field("text", True),
    "description": Field("text"),
    "channels": Field("items"),
    "members": Field("texts"),
    "owners": Field("texts"),
}
USER = {
    "username": Field("text", True),
    "email": Field("email", True),
    "nickname": Field("text", True),
    "teams": Field("texts"),
}
DIRECT_CHANNEL = {"members": Field("texts", True), "posts": Field("items")}

_SPAN = 1 << 32  # positions inside one document stay below this


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_idx, body): one document per file, numbered in path order."""
    try:
        raw = spark.read.text(path, wholetext=True).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")
        )
    except AnalysisException as exc:
        raise SourceError(f"input does not exist: {path}") from exc
    return global_index(raw, ["path"], "doc_idx", label="documents").select("doc_idx", "body")


_DOCUMENT = (
    "schema_version variant, version variant, "
    "users array<variant>, teams array<string>, direct_channels array<string>"
)


def parsed(docs: DataFrame) -> DataFrame:
    """(doc_idx, doc, readable) with the document's sections; parsed documents pass through."""
    if "doc" in docs.columns:
        return docs
    # One JSON value and nothing after it.
    values = F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), "array<string>")
    users = F.from_json("body", "users array<string>")["users"]
    doc = F.from_json("body", _DOCUMENT)
    whole = users.isNull() | doc["users"].isNotNull()
    return docs.select(
        "doc_idx", doc.alias("doc"), (F.coalesce(F.size(values) == 1, F.lit(False)) & whole).alias("readable")
    )


def unreadable(docs: DataFrame) -> DataFrame:
    """Documents that are not JSON, or hold a user or post that no variant can hold."""
    docs = parsed(docs)
    whole = docs.filter(~F.col("readable")).select("doc_idx")
    channels = team_channels(docs).filter(_posts_lost("channel.posts")).select("doc_idx")
    directs = sections(docs, "direct_channels").filter(_posts_lost("item.posts")).select("doc_idx")
    return whole.unionByName(channels).unionByName(directs)


def _posts_lost(posts: str) -> Column:
    return F.from_json("text", "posts array<string>")["posts"].isNotNull() & F.col(posts).isNull()


def _get(node: str, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(F.col(node), f"$.{path}", kind)


def _plain(path: str, kind: str = "string") -> Column:
    """Value of a variant column."""
    return F.try_variant_get(F.col(path), "$", kind)


def _texts(path: str) -> Column:
    return F.transform(path, lambda v: F.try_variant_get(v, "$", "string"))


def _type(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def bad_versions(docs: DataFrame) -> DataFrame:
    """(doc_idx, field, value) of declared versions other than 1 or "1"."""
    doc = parsed(docs)
    declared = None
    for field in ("schema_version", "version"):
        part = doc.select("doc_idx", F.lit(field).alias("field"), F.col(f"doc.{field}").alias("v"))
        declared = part if declared is None else declared.unionByName(part)
    kind = _type(F.col("v"))
    text = F.try_variant_get("v", "$", "string")
    scalar = kind.rlike("^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL)")
    fine = kind.isin("STRING", "BIGINT") & (text == "1")
    return declared.filter(scalar & ~fine).select("doc_idx", "field", text.alias("value"))


def _leaves(df: DataFrame, keep: list[str], array: Column, pos: str, out: str) -> DataFrame:
    """Explode an array of variants; items that are not objects are passed over."""
    return df.select(*keep, F.posexplode(array).alias(pos, out)).filter(
        _type(F.col(out)).startswith("OBJECT")
    )


def _outer(df: DataFrame, keep: list[str], array: Column, pos: str, out: str, fields: str) -> DataFrame:
    """Explode an array of object texts into ``text``, its field names ``keys`` and fields ``out``."""
    items = df.select(*keep, F.posexplode(array).alias(pos, "text"))
    return items.withColumn("keys", F.json_object_keys("text")).filter(F.col("keys").isNotNull()).withColumn(
        out, F.from_json("text", fields)
    )


def _shape(spec: dict[str, Field], inner: str) -> str:
    """Schema of an outer object; lists of plain items are variants, one by one."""
    kinds = {"texts": "array<variant>", "items": f"array<{inner}>"}
    return ", ".join(f"{name} {kinds.get(field.kind, 'variant')}" for name, field in spec.items())


def sections(docs: DataFrame, name: str) -> DataFrame:
    """(doc_idx, pos, idx, item): the objects of one section in document order."""
    docs, array = parsed(docs), F.col(f"doc.{name}")
    if name == "users":
        items = _leaves(docs, ["doc_idx"], array, "pos", "item")
    else:
        fields = _shape(TEAM, "string") if name == "teams" else _shape(DIRECT_CHANNEL, "variant")
        items = _outer(docs, ["doc_idx"], array, "pos", "item", fields)
    return items.withColumn("idx", F.col("doc_idx") * _SPAN + F.col("pos"))


def team_channels(docs: DataFrame) -> DataFrame:
    return _channels_of(sections(docs, "teams"))


def _channels_of(teams: DataFrame) -> DataFrame:
    return _outer(
        teams.withColumn("team_name", _plain("item.name")),
        ["doc_idx", "pos", "idx", "team_name"],
        F.col("item.channels"),
        "c_idx",
        "channel",
        _shape(CHANNEL, "variant"),
    )


def channel_posts(docs: DataFrame) -> DataFrame:
    return _posts_of(team_channels(docs))


def _posts_of(channels: DataFrame) -> DataFrame:
    return _leaves(
        channels.withColumn("channel_name", _plain("channel.name")),
        ["doc_idx", "pos", "idx", "c_idx", "team_name", "channel_name"],
        F.col("channel.posts"),
        "p_idx",
        "post",
    )


def direct_channel_posts(docs: DataFrame) -> DataFrame:
    return _direct_posts_of(sections(docs, "direct_channels"))


def _direct_posts_of(directs: DataFrame) -> DataFrame:
    return _leaves(
        directs,
        ["doc_idx", "pos", "idx"],
        F.col("item.posts"),
        "p_idx",
        "post",
    )


_INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0+)?\s*$"
_PLAIN_COUNT = r"^ *[0-9]{1,18} *\z"  # these two fit 64 bits
_PLAIN_NEGATIVE = r"^ *-[1-9][0-9]{0,17} *\z"
_FLAG_TRUE = ["true", "yes", "on", "t", "y", "1"]
_FLAG_FALSE = ["false", "no", "off", "f", "n", "0"]


def lax_integer(value: Column) -> Column:
    """Whole number of a variant: numbers, booleans, and texts such as " 12 ", "1_000", "1.0"."""
    kind = _type(value)
    text = F.try_variant_get(value, "$", "string")
    digits = F.regexp_replace(F.regexp_replace(F.trim(text), "_", ""), r"\.0+$", "")
    number = F.try_variant_get(value, "$", "decimal(38,6)")
    return (
        F.when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("decimal(38,0)"))
        .when(kind == "STRING", F.when(text.rlike(_INTEGER_TEXT), digits.try_cast("decimal(38,0)")))
        .when(
            kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (number == F.floor(number)),
            number.try_cast("decimal(38,0)"),
        )
    )


def lax_flag(value: Column) -> Column:
    """Boolean of a variant: booleans, 0/1, and the usual yes/no words in any case."""
    kind = _type(value)
    text = F.lower(F.try_variant_get(value, "$", "string"))
    word = F.when(text.isin(_FLAG_TRUE), True).when(text.isin(_FLAG_FALSE), False)
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(kind.isin("BOOLEAN", "STRING"), word)
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.when(number == 1, True).when(number == 0, False))
    )


def _value_problem(value: Column, field: Field) -> Column:
    """Null when the value fits the field; lists come as arrays."""
    kind = None if field.kind in ("texts", "items") else _type(value)
    if field.kind in ("text", "email"):
        bad = F.when(kind != "STRING", "must be a text")
        if field.kind == "email":
            bad = bad.when(
                ~F.try_variant_get(value, "$", "string").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),
                "must be an e-mail address",
            )
    elif field.kind == "count":
        number = lax_integer(value)
        # Plain numbers and texts of digits are judged without decimals, which cost ten times as much.
        whole = F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        digits = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        bad = (
            F.when((whole >= 0) | digits.rlike(_PLAIN_COUNT), None)
            .when((whole < 0) | digits.rlike(_PLAIN_NEGATIVE), "must not be negative")
            .when(number.isNull(), "must be a whole number")
            .when(number < 0, "must not be negative")
            .when(number > F.lit((1 << 63) - 1).cast("decimal(38,0)"), "must fit 64 bits")
        )
    elif field.kind == "flag":
        bad = F.when(lax_flag(value).isNull(), "must be a boolean")
    else:
        wanted = "STRING" if field.kind == "texts" else "OBJECT"
        bad = F.when(value.isNull(), "must be a list").when(
            F.exists(value, lambda e: ~_type(e).startswith(wanted)),
            "must hold only texts" if field.kind == "texts" else "must hold only objects",
        )
    if field.nullable:
        return F.when(kind != "VOID", bad)
    return bad


# The sections' names in reports.
_USERS, _TEAMS, _DIRECTS = "users.item", "teams.item", "direct_channels.item"


def _path(*parts: str) -> Column:
    """Array positions (columns) and field names (texts with dots) as one path."""
    return F.concat(*[F.lit(p) if "." in p else F.col(p).cast("string") for p in parts])


def _nodes(docs: DataFrame) -> list[tuple[dict[str, Field], DataFrame]]:
    """Per contract (section, doc_idx, path, node, keys): one row per object of the documents.

    Objects that hold others are staged, so that each text is parsed once and not once per level below it.
    """
    docs = stage(parsed(docs).select("doc_idx", "doc"), "docs")
    below = ["doc_idx", "pos", "idx", "keys", "item"]
    teams, directs = together(
        lambda: stage(sections(docs, "teams").select(*below), "teams"),
        lambda: stage(sections(docs, "direct_channels").select(*below), "directs"),
    )
    channels = stage(_channels_of(teams).drop("text"), "channels")

    def outer(df: DataFrame, section: str, node: str, path: Column) -> DataFrame:
        # Exploding keeps the parsed object from being parsed anew for each field.
        once = F.explode(F.array(node)).alias("node")
        return df.select(F.lit(section).alias("section"), "doc_idx", path.alias("path"), "keys", once)

    def leaf(df: DataFrame, section: str, node: str, path: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), "doc_idx", path.alias("path"), F.col(node).alias("node"))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("keys", F.map_keys(F.col("node").try_cast("map<string,variant>")))

    posts = leaf(
        _posts_of(channels), _TEAMS, "post", _path("pos", ".channels.", "c_idx", ".posts.", "p_idx")
    ).unionByName(leaf(_direct_posts_of(directs), _DIRECTS, "post", _path("pos", ".posts.", "p_idx")))
    attached = _get("node", "attachments", "array<variant>")
    files = _leaves(posts, ["section", "doc_idx", "path"], attached, "f_idx", "file")
    files = files.select(
        "section", "doc_idx", _path("path", ".attachments.", "f_idx").alias("path"), F.col("file").alias("node")
    )
    return [
        (USER, keyed(leaf(sections(docs, "users"), _USERS, "item", _path("pos")))),
        (TEAM, outer(teams, _TEAMS, "item", _path("pos"))),
        (CHANNEL, outer(channels, _TEAMS, "channel", _path("pos", ".channels.", "c_idx"))),
        (POST, keyed(posts)),
        (ATTACHMENT, keyed(files)),
        (DIRECT_CHANNEL, outer(directs, _DIRECTS, "item", _path("pos"))),
    ]


def _problems(spec: dict[str, Field], outer: bool) -> Column:
    """Array of (field, problem) of one object; the problem is null where a known field is right."""
    unknown = F.transform(
        F.array_except("keys", F.array(*map(F.lit, spec))),
        lambda k: F.struct(k.alias("field"), F.lit("is not a known field").alias("problem")),
    )
    checked = []
    for name, field in spec.items():
        listed = field.kind in ("texts", "items")
        value = F.col(f"node.{name}") if outer else _get("node", name, "array<variant>" if listed else "variant")
        if outer and name == "channels":
            # Items of this list are texts still.
            wrong = F.exists(value, lambda e: F.json_object_keys(e).isNull())
            problem = F.when(value.isNull(), "must be a list").when(wrong, "must hold only objects")
        else:
            problem = _value_problem(value, field)
        absent = F.lit("is required") if field.required else F.lit(None).cast("string")
        problem = F.when(~F.array_contains("keys", name), absent).otherwise(problem)
        checked.append(F.struct(F.lit(name).alias("field"), problem.alias("problem")))
    return F.concat(unknown, F.array(*checked))


def contract_violations(docs: DataFrame) -> DataFrame:
    """(section, doc_idx, path, field, problem) of everything that breaks the contract."""
    found = None
    for spec, nodes in _nodes(parsed(docs)):
        outer = nodes.schema["node"].dataType.typeName() == "struct"
        # A column of its own, so that what the problems of a field have in common is worked out once.
        listed = nodes.select("section", "doc_idx", "path", _problems(spec, outer).alias("ps"))
        part = listed.select("section", "doc_idx", "path", F.explode("ps").alias("p"))
        found = part if found is None else found.unionByName(part)
    return found.filter("p.problem is not null").select("section", "doc_idx", "path", "p.field", "p.problem")


def _post_columns(df: DataFrame, keep: list[Column]) -> DataFrame:
    files = F.coalesce(_get("post", "attachments", ATTACHMENTS), F.array().cast(ATTACHMENTS))
    return df.select(
        *keep,
        F.col("p_idx").cast("bigint").alias("p_idx"),
        _get("post", "username", "string").alias("username"),
        _get("post", "message", "string").alias("message"),
        lax_integer(_get("post", "timestamp_ms")).cast("bigint").alias("timestamp_ms"),
        _get("post", "id", "string").alias("id"),
        _get("post", "parent_id", "string").alias("parent_id"),
        files.alias("attachments"),
    )


def _people(df: DataFrame, node: str, keep: list[Column]) -> DataFrame:
    either = None
    for field, owner in (("members", False), ("owners", True)):
        part = df.select(
            *keep,
            F.explode(_texts(f"{node}.{field}")).alias("username"),
            F.lit(owner).alias("is_owner"),
        )
        either = part if either is None else either.unionByName(part)
    return either


def workspace(docs: DataFrame) -> Workspace:
    """Flatten checked documents into entity tables, array positions kept as indexes."""
    users = sections(docs, "users").withColumn("username", _get("item", "username", "string"))
    teams = sections(docs, "teams").withColumn("team_name", _plain("item.name"))
    chans = team_channels(docs).withColumn("channel_name", _plain("channel.name"))
    directs = sections(docs, "direct_channels")
    t_idx = F.col("idx").alias("t_idx")
    c_idx = F.col("c_idx").cast("bigint").alias("c_idx")
    return Workspace(
        users=users.select(
            F.col("idx").alias("u_idx"),
            "username",
            _get("item", "email", "string").alias("email"),
            _get("item", "nickname", "string").alias("nickname"),
        ),
        user_teams=users.select(
            F.col("idx").alias("u_idx"),
            "username",
            F.explode(_get("item", "teams", "array<string>")).alias("team_name"),
        ),
        teams=teams.select(
            t_idx,
            F.col("team_name").alias("name"),
            _plain("item.display_name").alias("display_name"),
            F.coalesce(_plain("item.description"), F.lit("")).alias("description"),
        ),
        team_people=_people(teams, "item", [t_idx, F.col("team_name")]),
        channels=chans.select(
            t_idx,
            c_idx,
            "team_name",
            F.col("channel_name").alias("name"),
            _plain("channel.display_name").alias("display_name"),
            F.coalesce(lax_flag(F.col("channel.is_private")), F.lit(False)).alias("is_private"),
        ),
        channel_people=_people(
            chans, "channel", [t_idx, c_idx, F.col("team_name"), F.col("channel_name")]
        ),
        posts=_post_columns(
            channel_posts(docs), [t_idx, c_idx, F.col("team_name"), F.col("channel_name")]
        ),
        direct_channels=directs.select(
            F.col("idx").alias("d_idx"), _texts("item.members").alias("members")
        ),
        direct_posts=_post_columns(direct_channel_posts(docs), [F.col("idx").alias("d_idx")]).drop(
            "parent_id"
        ),
    )


def load(docs: DataFrame) -> Workspace:
    """Check readability, version and contract, then flatten. Raises on the first fault.

    The parsed documents are staged: the checks and the nine entity tables all read them.
    """
    docs = stage(parsed(docs), "documents")
    broken = unreadable(docs).first()
    if broken:
        raise SourceError(f"document {broken.doc_idx} is not valid JSON")
    version = bad_versions(docs).first()
    if version:
        raise ContractError(f"Unsupported schema version: {version.value}. Expected: 1")
    fault = contract_violations(docs).first()
    if fault:
        raise ContractError(
            f"invalid object in '{fault.section}': {fault.path} {fault.field} {fault.problem}"
        )
    return workspace(docs)
