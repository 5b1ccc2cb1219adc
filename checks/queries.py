"""One query per operator, run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.functions.hashing import DEFAULT_SALT
from chatloom.operators import attachments, membership, monitor, naming, postimport, render
from chatloom.operators import resume, threads, usernames, validate
from chatloom.operators.sequence import position_in_group
from chatloom.plans import job
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage, stage_path
from chatloom.plans.workspace import Workspace
from chatloom.sources import api_pages, documents, entities, payload, relational, resumable
from chatloom.streaming import monitor as live

PLAIN = JobOptions()
ANON = JobOptions(anonymize=True)
CUTOFF_MS = 852_076_800_000  # 1997-01-01: an earlier run wrote the posts before it

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return keep


ws_of = relational.workspace


def _read(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return relational.table(spark, folder, name)


# --- derived inputs ------------------------------------------------------------------


def export_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One small export document per order and per conversation turn."""
    orders = _read("orders", spark, folder)
    customer = _read("customer", spark, folder)
    priority = F.col("o_orderpriority")
    post = F.struct(
        F.concat(F.lit("o"), "o_orderkey").alias("id"),
        F.col("c_name").alias("username"),
        priority.alias("message"),
        # Some sources write numbers as text.
        F.when(priority == "5-LOW", F.lit("-1"))
        .otherwise(F.concat(F.lit(" "), relational.epoch_ms(F.col("o_orderdate"))))
        .alias("timestamp_ms"),
        F.when(priority == "1-URGENT", F.col("o_orderstatus")).alias("flags"),
    )
    user = F.struct(
        F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") > 0, F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.col("c_mktsegment").alias("nickname"),
        F.array("c_mktsegment").alias("teams"),
    )
    channel = F.struct(
        priority.alias("name"),
        priority.alias("display_name"),
        F.when(F.col("o_orderstatus") == "O", "yes").otherwise("off").alias("is_private"),
        F.array("c_name").alias("members"),
        F.array(post).alias("posts"),
    )
    team = F.struct(
        F.col("c_mktsegment").alias("name"),
        F.initcap("c_mktsegment").alias("display_name"),
        F.array(channel).alias("channels"),
    )
    version = F.when(F.col("o_orderstatus") == "P", F.lit("1")).when(
        F.col("o_orderstatus") == "F", F.concat(F.lit("2"), F.substring(priority, 1, 1))
    )
    sold = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        (F.col("o_orderkey") * 2).alias("doc_idx"),
        F.to_json(
            F.struct(version.alias("version"), F.array(user).alias("users"), F.array(team).alias("teams"))
        ).alias("body"),
    )
    turn = F.struct(
        F.col("role").alias("username"),
        F.col("text").alias("message"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("timestamp_ms"),
    )
    chat = F.struct(
        F.when(F.col("role") == "system", F.array(F.lit("system")))
        .otherwise(F.array(F.lit("user"), F.lit("assistant")))
        .alias("members"),
        F.array(turn).alias("posts"),
    )
    said = _read("conversations", spark, folder).select(
        ((F.col("conv_id") * 1000 + F.col("turn")) * 2 + 1).alias("doc_idx"),
        F.to_json(F.struct(F.array(chat).alias("direct_channels"))).alias("body"),
    )
    return sold.unionByName(said)


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """API pages as a crawler would land them, one item per page."""
    region = _read("region", spark, folder)
    nation = _read("nation", spark, folder)
    customer = _read("customer", spark, folder)
    orders = _read("orders", spark, folder)
    talk = _read("conversations", spark, folder)

    def page(df: DataFrame, endpoint: str, parent, number, item) -> DataFrame:
        return df.select(
            F.lit(endpoint).alias("endpoint"),
            parent.cast("string").alias("parent_id"),
            number.cast("bigint").alias("page"),
            F.to_json(F.struct(F.array(item).alias("value"))).alias("body"),
        )

    def upn(name):
        return F.concat(name, F.lit("@corp.example.com"))

    none = F.lit(None).cast("string")
    poor = F.col("c_acctbal") < 0
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    principal = F.when(F.col("o_orderstatus") != "P", upn(F.col("c_name")))
    sold = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    message = F.struct(
        F.concat(F.lit("m"), "o_orderkey").alias("id"),
        F.struct(F.struct(principal.alias("userPrincipalName")).alias("user")).alias("from"),
        F.when(
            F.col("o_orderpriority") != "5-LOW",
            F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        ).alias("createdDateTime"),
        F.struct(F.when(F.col("o_totalprice") > 20000, F.col("o_orderpriority")).alias("content")).alias("body"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("m"), F.col("o_orderkey") - 25)).alias("replyToId"),
        F.when(
            F.col("o_orderpriority") == "2-HIGH",
            F.array(
                F.struct(
                    F.when(F.col("o_totalprice") > 250000, F.lit("note.pdf")).alias("name"),
                    F.concat(F.lit("https://files.example.com/"), "o_orderkey").alias("contentUrl"),
                )
            ),
        ).alias("attachments"),
    )
    chat_message = F.struct(
        F.concat_ws("-", F.lit("t"), F.col("conv_id"), F.col("turn")).alias("id"),
        F.struct(F.struct(upn(F.col("role")).alias("userPrincipalName")).alias("user")).alias("from"),
        F.lit("2024-01-02T03:04:05+02:00").alias("createdDateTime"),
        F.struct(F.col("text").alias("content")).alias("body"),
    )
    speakers = talk.groupBy("conv_id", "role").agg(
        F.min("turn").alias("turn"), F.max(F.length("text")).alias("longest")
    )
    parts = [
        page(
            customer,
            "users",
            none,
            F.col("c_custkey"),
            F.struct(
                F.when(F.col("c_acctbal") > -900, upn(F.col("c_name"))).alias("userPrincipalName"),
                F.when(~poor, F.concat(F.col("c_mktsegment"), F.lit("@mail.example.com"))).alias("mail"),
                F.when(poor, F.lit("")).otherwise(F.col("c_mktsegment")).alias("displayName"),
            ),
        ),
        page(
            region,
            "groups",
            none,
            F.col("r_regionkey"),
            F.struct(
                F.concat(F.lit("g"), "r_regionkey").alias("id"),
                F.when(F.col("r_regionkey") > 0, F.lower("r_name")).alias("mailNickname"),
                F.when(F.col("r_regionkey") > 1, F.col("r_name")).alias("displayName"),
            ),
        ),
        page(
            home.filter("c_acctbal > 9000"),
            "owners",
            F.concat(F.lit("g"), F.col("n_regionkey")),
            F.col("c_custkey"),
            F.struct(upn(F.col("c_name")).alias("userPrincipalName")),
        ),
        page(
            home,
            "members",
            F.concat(F.lit("g"), F.col("n_regionkey")),
            F.col("c_custkey"),
            F.struct(F.when(~poor, upn(F.col("c_name"))).alias("userPrincipalName")),
        ),
        page(
            nation,
            "channels",
            F.concat(F.lit("g"), F.col("n_regionkey")),
            F.col("n_nationkey"),
            F.struct(
                F.concat(F.lit("c"), "n_nationkey").alias("id"),
                F.when(F.col("n_nationkey") > 3, F.col("n_name")).alias("displayName"),
                F.when(F.col("n_nationkey") > 15, "private").otherwise("standard").alias("membershipType"),
            ),
        ),
        page(sold, "messages", F.concat(F.lit("c"), F.col("c_nationkey")), F.col("o_orderkey"), message),
        page(
            talk.select("conv_id").distinct(),
            "chats",
            none,
            F.col("conv_id"),
            F.struct(F.concat(F.lit("t"), "conv_id").alias("id")),
        ),
        page(
            speakers.filter("longest >= 120"),
            "chat_members",
            F.concat(F.lit("t"), "conv_id"),
            F.col("turn"),
            F.struct(
                F.when(F.col("role") == "user", upn(F.col("role"))).alias("userPrincipalName"),
                F.concat("role", F.lit("@mail.example.com")).alias("email"),
            ),
        ),
        page(talk, "chat_messages", F.concat(F.lit("t"), "conv_id"), F.col("turn"), chat_message),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as chat messages, with references a chat would hold."""
    tail = F.concat(
        F.lit(" Ticket EMP-"),
        1000 + F.col("doc_id"),
        F.lit(" E"),
        10000 + F.col("doc_id"),
        F.lit(" at https://wiki.example.com/page/"),
        F.col("doc_id"),
        F.lit(", thanks"),
        F.when(F.col("n_chars") < 400, F.lit(" Strictly CONFIDENTIAL")).otherwise(""),
    )
    return _read("documents", spark, folder).select("doc_id", F.concat("text", tail).alias("message"))


def name_list(spark: SparkSession, folder: str) -> DataFrame:
    """Workspace users named like the first words of the benchmark texts."""
    return _read("benchmark", spark, folder).select(
        F.col("item_id").alias("u_idx"),
        F.regexp_extract("text", r"(?U)^(\w+)", 1).alias("username"),
    )


def catalog(spark: SparkSession, folder: str) -> Workspace:
    """Parts as teams and channels: names repeat a lot."""
    part = _read("part", spark, folder)
    ws = ws_of(spark, folder)
    return replace(
        ws,
        teams=part.select(
            F.col("p_partkey").alias("t_idx"), F.col("p_name").alias("name"), "p_brand", F.lit("").alias("description")
        ).withColumnRenamed("p_brand", "display_name"),
        channels=part.select(
            F.col("p_size").cast("bigint").alias("t_idx"),
            F.col("p_partkey").alias("c_idx"),
            F.concat(F.lit("Size "), "p_size").alias("team_name"),
            F.col("p_type").alias("name"),
            F.col("p_name").alias("display_name"),
            F.lit(False).alias("is_private"),
        ),
    )


def join_list(column, sep: str = ","):
    return F.array_join(column, sep)


def files_text(column):
    return F.array_join(F.transform(column, lambda f: F.concat_ws("|", f["path"], f["file_id"])), ",")


def teams_text(column):
    """team:roles[channel:roles;…] joined, for comparison."""
    return F.array_join(
        F.transform(
            column,
            lambda t: F.concat(
                t["name"],
                F.lit(":"),
                F.array_join(t["roles"], "+"),
                F.lit("["),
                F.array_join(
                    F.transform(
                        t["channels"],
                        lambda c: F.concat(c["name"], F.lit(":"), F.array_join(c["roles"], "+")),
                    ),
                    ";",
                ),
                F.lit("]"),
            ),
        ),
        "|",
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Attachment sources at hand: those some finished order already used."""
    done = ws_of(spark, folder).posts.join(
        _read("orders", spark, folder).filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("p_idx")),
        "p_idx",
        "left_semi",
    )
    return done.select(F.explode("attachments").alias("a")).select(
        F.coalesce("a.url", "a.path").alias("source")
    )


# --- sources and sinks ---------------------------------------------------------------


@query("read_export")
def read_export(spark, folder):
    ws = documents.workspace(stage(documents.parsed(export_documents(spark, folder)), "docs"))
    return validate.summary(ws)


@query("version_gate")
def version_gate(spark, folder):
    return documents.bad_versions(export_documents(spark, folder))


@query("contract_violations")
def contract_violations(spark, folder):
    return documents.contract_violations(export_documents(spark, folder))


@query("flatten_posts")
def flatten_posts(spark, folder):
    ws = documents.workspace(export_documents(spark, folder))
    return ws.posts.select(
        "t_idx", "c_idx", "p_idx", "team_name", "channel_name", "username", "message", "timestamp_ms", "id"
    )


@query("flatten_channels")
def flatten_channels(spark, folder):
    ws = documents.workspace(export_documents(spark, folder))
    return ws.channels


@query("entity_posts")
def entity_posts(spark, folder):
    """Posts of the workspace written as one folder per entity and read back, with their place."""
    root = stage_path(spark, "entities")
    entities.write_entities(ws_of(spark, folder), root)
    ws = entities.workspace(entities.read_entities(spark, root))
    return ws.posts.select(
        "t_idx", F.col("p_idx").alias("place"), "team_name", "channel_name", "username", "message", "timestamp_ms",
        "id", "parent_id", F.array_join(F.transform("attachments", lambda a: a["path"]), ",").alias("files"),
    )


@query("entity_summary")
def entity_summary(spark, folder):
    """Counts of a workspace read from entity files, its people included."""
    root = stage_path(spark, "entities")
    entities.write_entities(ws_of(spark, folder), root)
    found = entities.read_entities(spark, root)
    ws = entities.workspace(found)
    tables = {name: getattr(ws, name) for name in ("users", "user_teams", "teams", "team_people", "channels", "channel_people", "direct_channels", "direct_posts")}
    counted = found.posts.limit(0).select(F.lit("").alias("entity"), F.lit(0).cast("bigint").alias("found"))
    for name, table in {**tables, "dangling": entities.dangling(found)}.items():
        counted = counted.unionByName(table.agg(F.count("*").alias("found")).select(F.lit(name).alias("entity"), "found"))
    return counted


@query("graph_users")
def graph_users(spark, folder):
    pages = stage(landed_pages(spark, folder), "pages")
    teams = api_pages.user_teams(pages).groupBy("u_idx").agg(
        F.array_join(F.array_sort(F.collect_set("team_name")), ",").alias("teams")
    )
    return (
        api_pages.users(pages)
        .join(teams, "u_idx", "left")
        .select("username", "email", "nickname", F.coalesce("teams", F.lit("")).alias("teams"))
    )


@query("graph_teams")
def graph_teams(spark, folder):
    return api_pages.teams(landed_pages(spark, folder)).drop("t_idx")


@query("graph_channels")
def graph_channels(spark, folder):
    pages = stage(landed_pages(spark, folder), "pages")
    people = api_pages.channel_people(pages).groupBy("t_idx", "c_idx").agg(
        F.count_if(~F.col("is_owner")).alias("members"), F.count_if("is_owner").alias("owners")
    )
    return (
        api_pages.channels(pages)
        .join(people, ["t_idx", "c_idx"], "left")
        .select("team_name", "name", "is_private", "members", "owners")
    )


@query("graph_posts")
def graph_posts(spark, folder):
    pages = stage(landed_pages(spark, folder), "pages")
    return api_pages.posts(pages).select(
        "team_name", "channel_name", "username", "message", "timestamp_ms", "id", "parent_id",
        F.array_join(F.transform("attachments", lambda a: F.concat_ws("|", a["name"], a["path"], a["url"])), ",").alias("files"),
    )


@query("graph_chats")
def graph_chats(spark, folder):
    pages = stage(landed_pages(spark, folder), "pages")
    talk = api_pages.direct_posts(pages).groupBy("d_idx").agg(
        F.count("*").alias("posts"), F.max("timestamp_ms").alias("last_ms")
    )
    return (
        api_pages.direct_channels(pages)
        .join(talk, "d_idx", "left")
        .select(join_list("members").alias("members"), "posts", "last_ms", F.floor(F.col("d_idx") / (1 << 32)).alias("conv_id"))
    )


def _written(spark, folder) -> DataFrame:
    return stage(render.all_records(ws_of(spark, folder), PLAIN), "records")


def _flat(records: DataFrame) -> DataFrame:
    """Common fields of every record type, for comparison."""
    return records.select(
        "type",
        F.coalesce(
            "team.name", "channel.name", "user.username", "post.id", "direct_post.id",
            join_list("direct_channel.members"),
        ).alias("name"),
        F.coalesce("channel.team", F.concat_ws("/", "post.team", "post.channel")).alias("place"),
        F.coalesce("post.user", "direct_post.user").alias("author"),
        F.coalesce(
            "post.message", "direct_post.message", "team.description", "channel.header", "user.nickname"
        ).alias("content"),
        F.coalesce("post.create_at", "direct_post.create_at").alias("create_at"),
        F.col("post.root_id").alias("root_id"),
    )


@query("payload_jsonl")
def payload_jsonl(spark, folder):
    path = stage_path(spark, "payload")
    payload.write_payload(_written(spark, folder), path)
    return _flat(resumable.typed(payload.read_lines(spark, path).select("line")))


@query("payload_parts")
def payload_parts(spark, folder):
    """Records per part at the smallest part size."""
    parts = payload.with_parts(_written(spark, folder), 17, 1)
    return parts.groupBy("part").agg(
        F.count("*").alias("records"), F.sum(F.octet_length("line") + 1).alias("bytes")
    )


@query("rollback_targets")
def rollback_targets(spark, folder):
    path = stage_path(spark, "payload")
    payload.write_payload(_written(spark, folder), path)
    return payload.rollback_targets(payload.read_lines(spark, path))


@query("attachment_manifest")
def attachment_manifest(spark, folder):
    return attachments.manifest(ws_of(spark, folder))


@query("attachment_outcome")
def attachment_outcome(spark, folder):
    return attachments.outcomes(attachments.manifest(ws_of(spark, folder)), listing(spark, folder))


# --- scalar functions ----------------------------------------------------------------


@query("slugify")
def slugify(spark, folder):
    docs = _read("documents", spark, folder)
    return docs.select("doc_id", tx.slugify(F.col("text")).alias("slug"))


@query("stable_alias")
def stable_alias(spark, folder):
    return _read("customer", spark, folder).select("c_custkey", tx.stable_alias(F.col("c_name")).alias("alias"))


@query("source_post_key")
def source_post_key(spark, folder):
    return threads.with_source_key(ws_of(spark, folder).posts, PLAIN).select("p_idx", "source_key")


@query("post_import_id")
def post_import_id(spark, folder):
    ws = ws_of(spark, folder)
    keyed = threads.with_source_key(ws.posts, PLAIN)
    return (
        keyed.join(naming.team_slugs(ws), "team_name")
        .join(naming.channel_slugs(ws), ["team_name", "channel_name"])
        .select(
            "p_idx",
            threads.import_id(F.col("team_slug"), F.col("channel_slug"), F.col("source_key"), PLAIN).alias("import_id"),
        )
    )


@query("direct_post_id")
def direct_post_id(spark, folder):
    return render.with_direct_id(ws_of(spark, folder), PLAIN).select("d_idx", "p_idx", "index", "id")


@query("email_norm")
def email_norm(spark, folder):
    users = ws_of(spark, folder).users
    return users.select("u_idx", tx.normalize_email(F.concat(F.lit("  "), "email", F.lit("\t"))).alias("email"))


@query("username_resolve")
def username_resolve(spark, folder):
    ws = ws_of(spark, folder)
    posts = ws.posts.select("p_idx", "username")
    plain = naming.resolve_username(posts, "username", naming.user_slugs(ws, PLAIN), PLAIN, "plain")
    return naming.resolve_username(plain, "username", naming.user_slugs(ws, ANON), ANON, "masked")


@query("attachment_name")
def attachment_name(spark, folder):
    return _read("pages", spark, folder).select("page_id", tx.safe_attachment_name(F.col("url")).alias("file_id"))


@query("keyword_scrub")
def keyword_scrub(spark, folder):
    return messages(spark, folder).select("doc_id", tx.scrub_block_words(F.col("message")).alias("message"))


def _redaction(rule: str) -> None:
    @query(f"redact_{rule}")
    def redact(spark, folder):
        return messages(spark, folder).select("doc_id", tx.redact(F.col("message"), [rule]).alias("message"))


for _rule in tx.REDACTIONS:
    _redaction(_rule.name)


@query("redact_usernames")
def redact_usernames(spark, folder):
    return usernames.redact_usernames(
        messages(spark, folder), "doc_id", "message", name_list(spark, folder), DEFAULT_SALT
    )


@query("redact_usernames_nested")
def redact_usernames_nested(spark, folder):
    """Users called like the alias of the first one, like the word of all aliases, and like its own hash."""
    names = name_list(spark, folder)
    first = names.agg(F.min_by("username", "u_idx").alias("username"))
    user = tx.stable_alias(F.lit("user"))
    more = F.array(tx.stable_alias(F.col("username")), F.lit("user"), F.substring(user, 6, 12))
    added = first.select(F.posexplode(more).alias("at", "username")).select(
        (F.col("at") + 1_000_000).cast("bigint").alias("u_idx"), "username"
    )
    everyone = names.select(F.col("u_idx").cast("bigint").alias("u_idx"), "username").unionByName(added)
    return usernames.redact_usernames(messages(spark, folder), "doc_id", "message", everyone, DEFAULT_SALT)


@query("anonymize_text")
def anonymize_text(spark, folder):
    return render.anonymize(messages(spark, folder), "doc_id", "message", name_list(spark, folder), ANON)


@query("iso_to_epoch_ms")
def iso_to_epoch_ms(spark, folder):
    moment = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), moment))
        .when(F.col("event_type") == "view", F.concat(moment, F.lit("+05:30")))
        .otherwise(F.concat(moment, F.lit("Z")))
    )
    return _read("events", spark, folder).select("event_id", tx.iso_to_epoch_ms(text).alias("ms"))


@query("upn_local_part")
def upn_local_part(spark, folder):
    return ws_of(spark, folder).users.select("u_idx", tx.upn_local_part(F.col("email")).alias("username"))


@query("member_key")
def member_key(spark, folder):
    return ws_of(spark, folder).direct_channels.select("d_idx", tx.member_key(F.reverse("members")).alias("key"))


def _auth(spark, folder, opts) -> DataFrame:
    ws = ws_of(spark, folder)
    maps = render.SlugMaps(naming.user_slugs(ws, opts), None, None)
    return render.identities(ws, maps, opts).select(
        "u_idx", "username", "email", "nickname", "auth_service", "auth_data"
    )


@query("user_auth")
def user_auth(spark, folder):
    return _auth(spark, folder, JobOptions(auth_service="saml"))


@query("user_auth_masked")
def user_auth_masked(spark, folder):
    return _auth(spark, folder, JobOptions(anonymize=True, auth_service="ldap"))


@query("user_auth_unmasked")
def user_auth_unmasked(spark, folder):
    return _auth(spark, folder, JobOptions(anonymize=True, auth_service="ldap", mask_auth_data=False))


# --- validation ----------------------------------------------------------------------


def _flat_key(found: DataFrame) -> DataFrame:
    return found.select(
        "rule", F.concat_ws(".", *[F.col(f"order_key.{n}").cast("string") for n in ("phase", "a", "a_stage", "b", "b_stage", "c", "c_stage")]).alias("place"), "message"
    )


def _check(name: str, rule, source=ws_of) -> None:
    @query(name)
    def run(spark, folder):
        return _flat_key(rule(source(spark, folder)))


_check("dup_users", validate.duplicate_users)
_check("dup_teams", validate.duplicate_teams, catalog)
_check("team_member_missing", validate.missing_team_people)
_check("dup_channels", validate.duplicate_channels, catalog)
_check("dup_posts", validate.duplicate_posts)
_check("post_author_missing", validate.missing_post_authors)
_check("reply_parent_unknown", validate.unknown_parents)
_check("channel_member_missing", validate.missing_channel_people, lambda s, f: _vendor_channels(s, f))
_check("user_unknown_teams", validate.unknown_user_teams)
_check("dm_arity", validate.bad_direct_sizes)
_check("dm_member_missing", validate.missing_direct_members)
_check("dm_author_missing", validate.missing_direct_authors)


def _vendor_channels(spark, folder) -> Workspace:
    """Channels also joined by suppliers, who are not users."""
    ws = ws_of(spark, folder)
    extra = (
        _read("supplier", spark, folder)
        .join(ws.channels, F.col("s_nationkey") == F.col("c_idx"))
        .select(
            "t_idx", "c_idx", "team_name", F.col("name").alias("channel_name"),
            F.col("s_name").alias("username"), (F.col("s_acctbal") > 5000).alias("is_owner"),
        )
    )
    return replace(ws, channel_people=ws.channel_people.unionByName(extra))


@query("empty_export")
def empty_export(spark, folder):
    """The whole workspace, and one that keeps only teams without any channel."""
    ws = ws_of(spark, folder)
    bare = replace(ws, teams=ws.teams.join(ws.channels, "t_idx", "left_anti"))
    full = validate.empty_export(ws).withColumn("workspace", F.lit("full"))
    return full.unionByName(validate.empty_export(bare).withColumn("workspace", F.lit("bare"))).select(
        "workspace", "rule", "message"
    )


@query("validation_violations")
def validation_violations(spark, folder):
    return validate.violations(ws_of(spark, folder)).groupBy("rule").agg(F.count("*").alias("found"))


@query("validation_report")
def validation_report(spark, folder):
    return _flat_key(validate.report(validate.violations(ws_of(spark, folder))))


@query("validation_summary")
def validation_summary(spark, folder):
    return validate.summary(ws_of(spark, folder))


@query("validation_slugs")
def validation_slugs(spark, folder):
    return validate.slug_sets(ws_of(spark, folder))


# --- naming --------------------------------------------------------------------------


@query("unique_slugs")
def unique_slugs(spark, folder):
    part = _read("part", spark, folder).select("p_partkey", "p_name")
    return naming.unique_slugs(part, "p_name", "p_partkey")


@query("unique_slugs_rivals")
def unique_slugs_rivals(spark, folder):
    """Names that are also the numbered form of other names: no plain SQL form."""
    name = F.when(F.col("p_size") > 25, F.lit("Brand")).when(
        F.col("p_size") > 20, F.concat(F.lit("Brand#"), "p_size", F.lit(" "), F.col("p_partkey") % 7)
    ).otherwise(F.col("p_brand"))
    part = _read("part", spark, folder).select("p_partkey", name.alias("name"))
    return naming.unique_slugs(part, "name", "p_partkey")


@query("slug_maps")
def slug_maps(spark, folder):
    return naming.slug_maps(ws_of(spark, folder), PLAIN)


@query("slug_maps_masked")
def slug_maps_masked(spark, folder):
    return naming.slug_maps(ws_of(spark, folder), ANON)


# --- membership ----------------------------------------------------------------------


@query("user_teams")
def user_teams(spark, folder):
    return membership.user_team_pairs(ws_of(spark, folder))


@query("team_roles")
def team_roles(spark, folder):
    return membership.team_roles(ws_of(spark, folder)).withColumn("roles", join_list("roles"))


@query("channel_visibility")
def channel_visibility(spark, folder):
    return membership.channel_roles(ws_of(spark, folder)).drop("roles")


@query("channel_roles")
def channel_roles(spark, folder):
    return membership.channel_roles(ws_of(spark, folder)).withColumn("roles", join_list("roles"))


@query("memberships")
def memberships(spark, folder):
    ws = ws_of(spark, folder)
    nested = membership.memberships(ws, naming.team_slugs(ws), naming.channel_slugs(ws))
    return nested.select("username", teams_text("teams").alias("teams"))


# --- records -------------------------------------------------------------------------


@query("team_records")
def team_records(spark, folder):
    ws = ws_of(spark, folder)
    return render.render_teams(ws, render.build_maps(ws, PLAIN))


@query("channel_records")
def channel_records(spark, folder):
    ws = ws_of(spark, folder)
    return render.render_channels(ws, render.build_maps(ws, PLAIN))


@query("user_records")
def user_records(spark, folder):
    ws = ws_of(spark, folder)
    opts = JobOptions(auth_service="saml", auth_data_field="username")
    return render.render_users(ws, render.build_maps(ws, opts), opts).withColumn("teams", teams_text("teams"))


def _posts(spark, folder, opts) -> DataFrame:
    ws = ws_of(spark, folder)
    outcome = stage(attachments.outcomes(attachments.manifest(ws), listing(spark, folder)), "attachments")
    return render.render_posts(ws, render.build_maps(ws, opts), opts, outcome).select(
        "p_idx", "id", "team", "channel", "user", "message", "create_at", "root_id",
        files_text("attachments").alias("attachments"), join_list("file_ids").alias("file_ids"),
    )


@query("post_records")
def post_records(spark, folder):
    return _posts(spark, folder, PLAIN)


@query("post_records_masked")
def post_records_masked(spark, folder):
    return _posts(spark, folder, ANON)


@query("direct_channel_records")
def direct_channel_records(spark, folder):
    ws = ws_of(spark, folder)
    return render.render_direct_channels(ws, render.build_maps(ws, PLAIN), PLAIN).withColumn(
        "members", join_list("members")
    )


def _direct(spark, folder, opts) -> DataFrame:
    ws = ws_of(spark, folder)
    return (
        render.render_direct_posts(ws, render.build_maps(ws, opts), opts)
        .withColumn("channel_members", join_list("channel_members"))
        .drop("attachments", "file_ids", "import_id")
    )


@query("direct_post_records")
def direct_post_records(spark, folder):
    return _direct(spark, folder, PLAIN)


@query("direct_post_records_masked")
def direct_post_records_masked(spark, folder):
    return _direct(spark, folder, ANON)


@query("all_records")
def all_records(spark, folder):
    return _flat(render.all_records(ws_of(spark, folder), PLAIN))


# --- threads -------------------------------------------------------------------------


@query("thread_roots")
def thread_roots(spark, folder):
    keyed = threads.with_source_key(ws_of(spark, folder).posts, PLAIN)
    return threads.thread_roots(threads.reply_links(keyed))


@query("thread_order")
def thread_order(spark, folder):
    threaded = threads.with_threads(ws_of(spark, folder).posts, PLAIN)
    keys = threaded.select(
        *[c.alias(n) for c, n in zip(
            threads.thread_sort_columns(),
            ["t_idx", "c_idx", "root_ts", "root_key", "is_reply", "timestamp_ms", "p_idx"], strict=True)]
    )
    placed = position_in_group(
        keys, ["t_idx", "c_idx"], ["root_ts", "root_key", "is_reply", "timestamp_ms", "p_idx"], "position"
    )
    return placed.select("c_idx", "p_idx", "root_ts", "root_key", "position")


@query("thread_root_id")
def thread_root_id(spark, folder):
    ws = ws_of(spark, folder)
    return render.render_posts(ws, render.build_maps(ws, PLAIN), PLAIN).select("p_idx", "root_id")


@query("orphan_replies")
def orphan_replies(spark, folder):
    return threads.orphan_replies(threads.with_threads(ws_of(spark, folder).posts, PLAIN))


# --- resume --------------------------------------------------------------------------


def _before_cutoff(records: DataFrame) -> DataFrame:
    at = F.coalesce("post.create_at", "direct_post.create_at", F.lit(0))
    return records.filter(at < CUTOFF_MS)


@query("resume_entities")
def resume_entities(spark, folder):
    """What a second run still writes after one that got as far as the cutoff."""
    records = _written(spark, folder)
    return _flat(resume.remaining(records, _before_cutoff(records)))


@query("resume_posts")
def resume_posts(spark, folder):
    records = _written(spark, folder)
    written = _before_cutoff(records)
    state = resume.resume_state(written)
    left = resume.remaining_by_state(records, written, state, resume.finished_scopes(written))
    return _flat(left)


@query("resume_state")
def resume_state(spark, folder):
    return resume.resume_state(_written(spark, folder))


@query("finished_channels")
def finished_channels(spark, folder):
    return resume.finished_scopes(_before_cutoff(_written(spark, folder)))


@query("record_stats")
def record_stats(spark, folder):
    return resume.record_stats(_written(spark, folder))


@query("resume_state_batches")
def resume_state_batches(spark, folder):
    """The state kept up over four batches of records instead of worked out at the end."""
    records = _written(spark, folder)
    key = F.coalesce("post.id", "direct_post.id", F.lit(""))
    state = resume.resume_state(records.filter("false"))
    for number in range(4):
        batch = records.filter(F.pmod(F.xxhash64(key), F.lit(4)) == number)
        state = stage(resume.merged_state(state, batch), "state")
    return state


def _cut_payload(spark, folder) -> tuple[resumable.Folder, DataFrame]:
    """A payload folder whose run ended at the cutoff, and all records."""
    records = _written(spark, folder)
    out = resumable.Folder(spark, stage_path(spark, "payload"), "chat")
    resumable.write(out, _before_cutoff(records), 500, 1, resumable.gate(out))
    return out, records


@query("resume_payload")
def resume_payload(spark, folder):
    """What the parts hold after a run that was cut and one that went on from its manifest."""
    out, records = _cut_payload(spark, folder)
    start = resumable.gate(out)
    resumable.write(out, stage(resume.remaining(records, start.written), "left"), 500, 1, start)
    return _flat(resumable.read_records(out))


@query("resume_gate")
def resume_gate(spark, folder):
    """Records a further run writes: on a payload with its manifest, without it, and on none."""
    out, records = _cut_payload(spark, folder)
    counted = None
    for case in ("with manifest", "no manifest", "no payload"):
        if case == "no manifest":
            out.delete(resumable.MANIFEST)
        if case == "no payload":
            out = resumable.Folder(spark, stage_path(spark, "payload"), "chat")
        start = resumable.gate(out)
        left = resume.remaining(records, start.written)
        found = left.groupBy("type").agg(F.count("*").alias("records")).select(
            F.lit(case).alias("payload"), F.lit(start.resumed).alias("resumed"), "type", "records"
        )
        counted = found if counted is None else counted.unionByName(found)
    return counted


# --- after the import ----------------------------------------------------------------


@query("dedupe_import")
def dedupe_import(spark, folder):
    return postimport.keep_first_import(relational.target_posts(spark, folder))


@query("verify_counts")
def verify_counts(spark, folder):
    ws = ws_of(spark, folder)
    return postimport.verify_counts(ws.teams, ws.channels, ws.users, relational.target_posts(spark, folder))


@query("import_idempotent")
def import_idempotent(spark, folder):
    """Posts left after one and after two imports."""
    once = relational.target_posts(spark, folder)
    twice = postimport.import_again(once)
    counted = None
    for label, df in (("once", once), ("twice", twice)):
        part = postimport.keep_first_import(df).agg(F.count("*").alias("posts")).withColumn("imports", F.lit(label))
        counted = part if counted is None else counted.unionByName(part)
    return counted


# --- monitoring ----------------------------------------------------------------------

SERIES = ["user_id", "event_type"]


def _samples(spark, folder, metric: str) -> DataFrame:
    picked = monitor.select_series(relational.samples(spark, folder), metric)
    return picked.withColumn("series", F.col("labels")["series"]).withColumn(
        "container", F.col("labels")["container"]
    )


@query("metric_counters")
def metric_counters(spark, folder):
    return monitor.counters(_read("events", spark, folder), "event_type", "user_id")


@query("stage_histogram")
def stage_histogram(spark, folder):
    runs = _read("events", spark, folder).withColumn("seconds_taken", F.col("value") / 10)
    return monitor.stage_histogram(runs, "event_type", "seconds_taken").withColumn(
        "seconds", F.round("seconds", 4)
    )


@query("throughput")
def throughput(spark, folder):
    runs = _read("events", spark, folder).select(
        "ts",
        F.col("event_id").alias("run_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records"),
        F.floor("value").alias("seconds"),
        "user_id",
    )
    return monitor.throughput(runs, ["user_id"]).withColumn("records_per_second", F.round("records_per_second", 6))


@query("counter_increase")
def counter_increase(spark, folder):
    return monitor.increase_alert(_samples(spark, folder, "work_total"), ["series", "container"], ["container"])


@query("rate_by_label")
def rate_by_label(spark, folder):
    rates = monitor.rate_by_label(_samples(spark, folder, "work_total"), ["series", "container"], "container", 60)
    return rates.withColumn("rate", F.round("rate", 6))


@query("gauge_sum_by_label")
def gauge_sum_by_label(spark, folder):
    return monitor.gauge_sum_by_label(_samples(spark, folder, "memory_bytes"), ["series", "container"], "container")


@query("sustained_alert")
def sustained_alert(spark, folder):
    held = monitor.sustained(
        _samples(spark, folder, "up"), ["series", "container"], F.col("value") == 0, 5
    )
    return held


def _arrivals(spark, folder, metric: str) -> DataFrame:
    """Samples as a stream of files: three slices by arrival, each row up to a day late."""
    late = F.make_dt_interval(secs=F.pmod(F.xxhash64("event_id"), F.lit(86_400)))
    arrived = _samples(spark, folder, metric).select(
        F.concat_ws("/", "series", "container").alias("series"), "ts", "event_id", "value",
        F.unix_timestamp(F.col("ts") + late).alias("arrived"),
    )
    arrived = stage(arrived, "arrivals")
    bounds = arrived.agg(F.min("arrived").alias("low"), F.max("arrived").alias("high")).first()
    width = ((bounds.high or 0) - (bounds.low or 0)) // 3 + 1
    path = stage_path(spark, "stream-in")
    for number in range(3):
        part = arrived.filter(F.floor((F.col("arrived") - (bounds.low or 0)) / width) == number)
        part.drop("arrived").write.mode("append").parquet(path)
    return spark.readStream.schema(arrived.drop("arrived").schema).option("maxFilesPerTrigger", 8).parquet(path)


def _drained(out: DataFrame, label: str) -> DataFrame:
    """What a stream has written when it has taken all that is there."""
    spark = out.sparkSession
    path = stage_path(spark, label)
    writer = out.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer.option("checkpointLocation", stage_path(spark, f"{label}-state")).start(path).awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


DELAY_DAYS = 12  # longer than a slice of the month and a day


@query("stream_counter_steps")
def stream_counter_steps(spark, folder):
    arrivals = _arrivals(spark, folder, "work_total")
    return _drained(live.counter_steps(arrivals, f"{DELAY_DAYS} days", "event_id"), "live-steps")


@query("stream_held_alert")
def stream_held_alert(spark, folder):
    down = _arrivals(spark, folder, "up").withColumn("ok", F.col("value") == 0)
    return _drained(live.held_threshold(down, 6 * 3600, f"{DELAY_DAYS} days", "event_id"), "live-held")


@query("held_alert")
def held_alert(spark, folder):
    """The batch form of the alert, at the end of all samples."""
    ups = _samples(spark, folder, "up")
    end = ups.agg(F.max("ts").alias("end")).first().end
    return monitor.held(ups, ["series", "container"], F.col("value") == 0, 360, F.lit(end))


@query("select_series")
def select_series(spark, folder):
    picked = monitor.select_series(relational.samples(spark, folder), "mem*", container="click")
    return picked.select("event_id", "ts", "metric", "value", F.col("labels")["series"].alias("series"))


@query("log_select")
def log_select(spark, folder):
    logs = monitor.parse_logs(relational.log_lines(spark, folder))
    picked = monitor.select_logs(logs, service="chat-server|postgres|metrics", level="ERROR|WARN")
    return picked.withColumn("details", F.col("details")["k"])


# --- job -----------------------------------------------------------------------------


@query("run_summary")
def run_summary(spark, folder):
    return job.summarize(ws_of(spark, folder), _written(spark, folder))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the workspace as its JSON line."""
    return render.json_lines(render.all_records(ws_of(spark, folder), PLAIN)).select("type", "line")
