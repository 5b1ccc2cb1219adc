"""SQL forms of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

# Fixed values, written out here as well, so that a wrong one in the library shows.
SALT = b"default-anonymization-salt-value"
_INNER = bytes(b ^ 0x36 for b in SALT.ljust(64, b"\0")).hex()
_OUTER = bytes(b ^ 0x5C for b in SALT.ljust(64, b"\0")).hex()
BLOCKED_TEXT = "[PII SCRUBBED]"
REDACTIONS = (
    ("card", r"\b(?:\d[ -]*?){13,19}\b", "[REDACTED CREDIT CARD]"),
    ("email", r"[a-zA-Z0-9_.+\-İıſK]+@[a-zA-Z0-9\-İıſK]+\.[a-zA-Z0-9\-.İıſK]+", "[REDACTED EMAIL]"),
    ("phone", r"\b(?:\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", "[REDACTED PHONE]"),
    ("employee_id", r"\b(?:EMP|emp)-\d{4,8}\b|\bE\d{5,8}\b", "[REDACTED EMPLOYEE ID]"),
    ("url", r"https?://[^\s]+", "[REDACTED URL]"),
    ("ip", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[REDACTED IP]"),
)
DURATION_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def hmac(text: str, length: int = 12) -> str:
    return (
        f"substr(sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({text})))), 1, {length})"
    )


def alias(text: str) -> str:
    return f"('user-' || {hmac(text)})"


def slug(text: str) -> str:
    core = f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', '-', 'g'), '-')"
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN 'default-slug' "
        f"WHEN {core} = '' THEN 'fallback-' || substr(sha256({text}), 1, 10) ELSE {core} END"
    )


# The workspace over the given tables.
BASE: dict[str, str] = {
    "people": """
        SELECT c.*, n.*, r.*, CASE WHEN c_acctbal < -900 THEN 'Guest ' || c_mktsegment
            WHEN c_acctbal < -850 THEN 'guest-' || lower(c_mktsegment) ELSE c_name END AS username
        FROM customer c JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey""",
    "users": """
        SELECT c_custkey AS u_idx, username, c_name || '@Example.COM' AS email, c_name AS nickname FROM people""",
    "user_teams": """
        SELECT c_custkey AS u_idx, username, r_name AS team_name FROM people WHERE c_mktsegment <> 'HOUSEHOLD'
        UNION ALL SELECT c_custkey, username, c_mktsegment FROM people WHERE c_acctbal < -500""",
    "teams": """
        SELECT r_regionkey AS t_idx, r_name AS name, CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
            ELSE r_name[1] || lower(r_name[2:]) END AS display_name, 'Region ' || r_name AS description
        FROM region""",
    "team_people": """
        SELECT r_regionkey AS t_idx, r_name AS team_name, username, false AS is_owner FROM people WHERE c_acctbal >= 0
        UNION ALL SELECT r_regionkey, r_name, s_name, false FROM supplier
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT r.r_regionkey, r.r_name, p.username, true
            FROM people p JOIN region r ON r.r_regionkey = (p.n_regionkey + 1) % 5 WHERE c_acctbal > 9500""",
    "channels": """
        SELECT r_regionkey AS t_idx, n_nationkey AS c_idx, r_name AS team_name, n_name AS name,
            'Nation ' || n_nationkey AS display_name, n_nationkey > 15 AS is_private
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "channel_people": """
        SELECT r_regionkey AS t_idx, n_nationkey AS c_idx, r_name AS team_name, n_name AS channel_name, username,
            false AS is_owner FROM people WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT r_regionkey, n_nationkey, r_name, n_name, username, true FROM people WHERE c_acctbal > 9000""",
    "posts": """
        SELECT t_idx, c_idx, o_orderkey AS p_idx, team_name, name AS channel_name,
            CASE WHEN o_totalprice > 450000 THEN 'Desk ' || o_orderpriority ELSE p.username END AS username,
            'Order ' || o_orderkey || ' ' || o_orderpriority || ' for ' || c_name AS message,
            epoch_ms(o_orderdate) AS timestamp_ms,
            CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                WHEN o_totalprice < 5000 THEN 'quote-' || year(o_orderdate) ELSE 'o' || o_orderkey END AS id,
            'o' || (o_orderkey + CASE WHEN o_orderstatus = 'F' THEN -25
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 25
                WHEN o_orderstatus = 'P' THEN -75 END) AS parent_id,
            CASE WHEN o_orderpriority = '2-HIGH' THEN [
                {'name': 'invoice.pdf', 'path': 'invoices/' || o_custkey || '/invoice ' || year(o_orderdate) || '.pdf', 'url': NULL},
                {'name': 'terms.pdf', 'path': 'terms/' || year(o_orderdate) || '.pdf',
                 'url': 'https://files.example.com/terms/' || year(o_orderdate) || '.pdf'}] ELSE [] END AS attachments,
            o_orderstatus
        FROM orders JOIN people p ON o_custkey = c_custkey JOIN channels ON o_orderkey % 25 = c_idx""",
    "talk": """
        SELECT conv_id, turn, text, role,
            CASE WHEN role = 'user' THEN 'Customer#' || lpad(conv_id::VARCHAR, 9, '0') ELSE role END AS username
        FROM conversations""",
    "direct_channels": """
        SELECT conv_id AS d_idx, coalesce(list_sort(list(DISTINCT username) FILTER (length(text) >= 120)), []) AS members
        FROM talk GROUP BY conv_id""",
    "direct_posts": """
        SELECT conv_id AS d_idx, turn AS p_idx, username, text AS message,
            1700000000000 + conv_id * 1000 + (turn * 3) % 4 AS timestamp_ms FROM talk""",
    "user_map": f"""
        SELECT username, arg_max(slug, u_idx) AS slug FROM (
            SELECT username, u_idx, base || CASE WHEN nth = 1 THEN '' ELSE '-' || (nth - 1) END AS slug FROM (
                SELECT *, row_number() OVER (PARTITION BY base ORDER BY u_idx) AS nth
                FROM (SELECT username, u_idx, {slug('username')} AS base FROM users))) GROUP BY username""",
    "team_map": f"SELECT name AS team_name, {slug('name')} AS team_slug FROM teams",
    "channel_map": f"SELECT team_name, name AS channel_name, {slug('name')} AS channel_slug FROM channels",
    "keyed": f"""
        SELECT *, coalesce(nullif(id, ''), 'source-post-' || {hmac("concat_ws('|', team_name, channel_name, p_idx, timestamp_ms, username, message)")}) AS source_key
        FROM posts""",
    "links": """
        SELECT t_idx, c_idx, source_key, arg_max(parent_id, p_idx) AS parent FROM keyed
        WHERE parent_id IS NOT NULL GROUP BY ALL""",
    "walk": """
        SELECT t_idx, c_idx, source_key, source_key AS cur, [source_key] AS path FROM links
        UNION ALL SELECT w.t_idx, w.c_idx, w.source_key, l.parent, list_append(path, l.parent)
        FROM walk w JOIN links l ON w.t_idx = l.t_idx AND w.c_idx = l.c_idx AND w.cur = l.source_key
        WHERE NOT list_contains(path, l.parent)""",
    "roots": """
        SELECT t_idx, c_idx, source_key, arg_max(cur, len(path)) AS root FROM walk
        GROUP BY t_idx, c_idx, source_key""",
    "heads": """
        SELECT k.t_idx, k.c_idx, k.source_key, coalesce(any_value(root), k.source_key) AS root_key,
            arg_max(k.timestamp_ms, k.p_idx) AS ts
        FROM keyed k LEFT JOIN roots r ON k.t_idx = r.t_idx AND k.c_idx = r.c_idx AND k.source_key = r.source_key
        GROUP BY k.t_idx, k.c_idx, k.source_key""",
    "threaded": """
        SELECT k.*, h.root_key, x.source_key IS NOT NULL AS root_exists,
            coalesce(CASE WHEN x.root_key = x.source_key THEN x.ts END, k.timestamp_ms) AS root_ts
        FROM keyed k JOIN heads h ON k.c_idx = h.c_idx AND k.source_key = h.source_key
        LEFT JOIN heads x ON x.c_idx = h.c_idx AND x.source_key = h.root_key""",
    "mentions": """
        SELECT p_idx, unnest(attachments) AS a, generate_subscripts(attachments, 1) AS pos, t_idx, c_idx, o_orderstatus
        FROM posts""",
    "manifest": """
        SELECT f.name, f.path, coalesce(f.url, f.path) AS source,
            coalesce(starts_with(f.url, 'https://') OR starts_with(f.url, 'http://'), false) AS remote,
            substr(sha256(f.path), 1, 8) || '_' || regexp_replace(split_part(f.path, '/', -1), '[^a-zA-Z0-9.-]+', '_', 'g') AS file_id
        FROM (SELECT arg_min(a, (t_idx, c_idx, p_idx, pos)) AS f FROM mentions GROUP BY a.path)""",
    "outcome": """
        SELECT m.*, CASE WHEN source IN (SELECT coalesce(a.url, a.path) FROM mentions WHERE o_orderstatus = 'F')
            THEN 'success' ELSE 'failed' END AS status FROM manifest m""",
    "delivered": """
        SELECT p_idx, string_agg('attachments/' || file_id || '|' || file_id, ',' ORDER BY pos) AS attachments,
            string_agg(file_id, ',' ORDER BY pos) AS file_ids
        FROM mentions JOIN outcome ON a.path = outcome.path WHERE status = 'success' GROUP BY p_idx""",
    "pairs": """
        SELECT DISTINCT username, team_name FROM (SELECT username, team_name FROM user_teams
            UNION ALL SELECT username, team_name FROM team_people UNION ALL SELECT username, team_name FROM channel_people)""",
    "t_roles": """
        SELECT username, team_name, CASE WHEN EXISTS (SELECT 1 FROM team_people t WHERE t.is_owner
            AND t.username = pairs.username AND t.team_name = pairs.team_name)
            THEN 'team_admin,team_user' ELSE 'team_user' END AS roles FROM pairs""",
    "c_roles": """
        SELECT p.username, p.team_name, c.name AS channel_name, c.c_idx,
            CASE WHEN bool_or(cp.is_owner) THEN 'channel_admin,channel_user' ELSE 'channel_user' END AS roles
        FROM pairs p JOIN channels c ON p.team_name = c.team_name
        LEFT JOIN channel_people cp ON cp.username = p.username AND cp.c_idx = c.c_idx
        WHERE NOT c.is_private OR cp.username IS NOT NULL
        GROUP BY p.username, p.team_name, c.name, c.c_idx""",
    "nested": f"""
        SELECT t.username, string_agg(t.team_slug || ':' || t.roles || '[' || coalesce(c.chans, '') || ']', '|' ORDER BY t.t_idx) AS teams
        FROM (SELECT r.username, r.team_name, replace(r.roles, ',', '+') AS roles, coalesce(tm.team_slug, {slug('r.team_name')}) AS team_slug,
                coalesce(ts.t_idx, 99) AS t_idx
              FROM t_roles r LEFT JOIN team_map tm ON r.team_name = tm.team_name LEFT JOIN teams ts ON ts.name = r.team_name) t
        LEFT JOIN (SELECT username, team_name, string_agg({slug('channel_name')} || ':' || replace(roles, ',', '+'), ';' ORDER BY c_idx) AS chans
              FROM c_roles GROUP BY username, team_name) c
        ON t.username = c.username AND t.team_name = c.team_name GROUP BY t.username""",
    "members": f"""
        SELECT d.d_idx, string_agg(coalesce(m.slug, {slug('d.name')}), ',' ORDER BY pos) AS members
        FROM (SELECT d_idx, unnest(members) AS name, generate_subscripts(members, 1) AS pos FROM direct_channels) d
        LEFT JOIN user_map m ON d.name = m.username GROUP BY d.d_idx""",
    "members_masked": f"""
        SELECT d.d_idx, string_agg({alias('d.name')}, ',' ORDER BY pos) AS members
        FROM (SELECT d_idx, unnest(members) AS name, generate_subscripts(members, 1) AS pos FROM direct_channels) d
        GROUP BY d.d_idx""",
    "direct_ranked": f"""
        SELECT *, 'direct-post-' || {hmac("concat_ws('|', people, idx, timestamp_ms, username, message)")} AS id FROM (
            SELECT p.*, row_number() OVER (PARTITION BY p.d_idx ORDER BY timestamp_ms, p_idx) - 1 AS idx,
                coalesce(list_aggregate(list_sort(members), 'string_agg', ','), '') AS people
            FROM direct_posts p JOIN direct_channels c ON p.d_idx = c.d_idx)""",
    "import_posts": f"""
        SELECT t.*, team_slug, channel_slug,
            'post-' || {hmac("concat_ws('|', team_slug, channel_slug, source_key)")} AS import_id,
            CASE WHEN parent_id IS NOT NULL AND root_exists AND root_key <> source_key
                THEN 'post-' || {hmac("concat_ws('|', team_slug, channel_slug, root_key)")} END AS root_id
        FROM threaded t JOIN team_map USING (team_name) JOIN channel_map USING (team_name, channel_name)""",
    "flat": f"""
        SELECT 'version' AS type, NULL AS name, '' AS place, NULL AS author, NULL AS content, NULL::BIGINT AS create_at,
            NULL AS root_id, NULL::BIGINT AS c_idx
        UNION ALL SELECT 'team', team_slug, '', NULL, description, NULL, NULL, NULL
            FROM teams JOIN team_map ON name = team_name
        UNION ALL SELECT 'channel', channel_slug, team_slug, NULL, 'Migrated from Teams: ' || display_name, NULL, NULL, NULL
            FROM channels JOIN team_map USING (team_name) JOIN channel_map ON channels.name = channel_name
        UNION ALL SELECT 'user', slug, '', NULL, nickname, NULL, NULL, NULL FROM users JOIN user_map USING (username)
        UNION ALL SELECT 'post', import_id, team_slug || '/' || channel_slug, coalesce(slug, {slug('p.username')}), message,
            timestamp_ms, root_id, c_idx FROM import_posts p LEFT JOIN user_map m ON p.username = m.username
        UNION ALL SELECT 'direct_channel', coalesce(members, ''), '', NULL, NULL, NULL, NULL, NULL
            FROM (SELECT d_idx FROM direct_channels) LEFT JOIN members USING (d_idx)
        UNION ALL SELECT 'direct_post', id, '', coalesce(slug, {slug('p.username')}), message, timestamp_ms, NULL, d_idx
            FROM direct_ranked p LEFT JOIN user_map m ON p.username = m.username""",
    "messages": """
        SELECT doc_id, text || ' Ticket EMP-' || (1000 + doc_id) || ' E' || (10000 + doc_id)
            || ' at https://wiki.example.com/page/' || doc_id || ', thanks'
            || CASE WHEN n_chars < 400 THEN ' Strictly CONFIDENTIAL' ELSE '' END AS message FROM documents""",
    "names": f"""
        SELECT row_number() OVER (ORDER BY min(item_id)) AS rank, username, {alias('username')} AS alias
        FROM (SELECT item_id, regexp_extract(text, '^([\\p{{L}}\\p{{N}}_\\p{{M}}]+)', 1) AS username FROM benchmark) WHERE username <> ''
        GROUP BY username""",
    "target_posts": """
        SELECT event_id AS id, epoch_us(ts) // 1000 AS createat, CASE event_type
            WHEN 'error' THEN '{"note": ' || (props->>'k') || '}'
            WHEN 'signup' THEN '{"import_id": ' || (props->>'k') || '}'
            ELSE '{"import_id" : "post-' || (props->>'k') || '"}' END AS props FROM events""",
    "samples": """
        SELECT date_trunc('second', ts) AS ts, event_id, user_id::VARCHAR AS series,
            CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS container, value AS gauge,
            (event_id % 1000)::DOUBLE AS counter, value < 25 AS down FROM events""",
    "steps": """
        SELECT *, CASE WHEN counter >= prev THEN counter - prev ELSE counter END AS step FROM (
            SELECT *, lag(counter) OVER w AS prev, lag(ts) OVER w AS prev_ts FROM samples
            WINDOW w AS (PARTITION BY series, container ORDER BY ts, event_id)) WHERE prev IS NOT NULL""",
    "sold": """
        SELECT o.*, c.*, o_orderkey * 2 AS doc_idx FROM orders o JOIN customer c ON o_custkey = c_custkey""",
    "said": "SELECT *, (conv_id * 1000 + turn) * 2 + 1 AS doc_idx FROM conversations",
    "graph_teams": """
        SELECT r_regionkey, 'g' || r_regionkey AS group_id, CASE WHEN r_regionkey > 0 THEN lower(r_name) ELSE 'g0' END AS name,
            CASE WHEN r_regionkey > 1 THEN r_name WHEN r_regionkey = 1 THEN lower(r_name) ELSE 'g0' END AS display_name,
            '' AS description FROM region""",
    "graph_channels": """
        SELECT n_nationkey, n_regionkey, t.name AS team_name, CASE WHEN n_nationkey > 3 THEN n_name ELSE 'c' || n_nationkey END AS name,
            n_nationkey > 15 AS is_private FROM nation JOIN graph_teams t ON n_regionkey = t.r_regionkey""",
}

def _needs(text: str) -> list[str]:
    """Names of base tables a text refers to, in definition order."""
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in BASE if name in words]


def with_base(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with just the base tables it needs."""
    extra = extra or {}
    wanted: set[str] = set()
    todo = _needs(body + " ".join(extra.values()))
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _needs(BASE[name])
    wanted -= set(extra)
    parts = [f"{name} AS ({BASE[name]})" for name in BASE if name in wanted]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + body


ORACLE: dict[str, str] = {}


def add(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = with_base(body, extra)


# --- sources and sinks ---------------------------------------------------------------

SPAN = 1 << 32
add(
    "read_export",
    "SELECT (SELECT count(*) FROM sold) AS teams, (SELECT count(*) FROM sold) AS channels, "
    "(SELECT count(*) FROM sold) AS users, (SELECT count(*) FROM sold) AS posts, "
    "(SELECT count(*) FROM said) AS direct_channels, (SELECT count(*) FROM said) AS direct_posts",
)
add(
    "version_gate",
    "SELECT doc_idx, 'version' AS field, '2' || o_orderpriority[1] AS value FROM sold WHERE o_orderstatus = 'F'",
)
add(
    "contract_violations",
    """
    SELECT 'users.item' AS section, doc_idx, '0' AS path, 'email' AS field, 'is required' AS problem FROM sold WHERE c_acctbal <= 0
    UNION ALL SELECT 'users.item', doc_idx, '0', 'email', 'must be an e-mail address' FROM sold
        WHERE c_acctbal > 0 AND NOT regexp_matches(c_name || '@example.com', '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')
    UNION ALL SELECT 'teams.item', doc_idx, '0.channels.0.posts.0', 'timestamp_ms', 'must not be negative' FROM sold
        WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'teams.item', doc_idx, '0.channels.0.posts.0', 'flags', 'is not a known field' FROM sold
        WHERE o_orderpriority = '1-URGENT'""",
)
add(
    "flatten_posts",
    f"""SELECT doc_idx * {SPAN} AS t_idx, 0 AS c_idx, 0 AS p_idx, c_mktsegment AS team_name, o_orderpriority AS channel_name,
        c_name AS username, o_orderpriority AS message,
        CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE epoch_ms(o_orderdate) END AS timestamp_ms, 'o' || o_orderkey AS id FROM sold""",
)
add(
    "flatten_channels",
    f"""SELECT doc_idx * {SPAN} AS t_idx, 0 AS c_idx, c_mktsegment AS team_name, o_orderpriority AS name,
        o_orderpriority AS display_name, o_orderstatus = 'O' AS is_private FROM sold""",
)
add(
    "graph_users",
    """SELECT c_name AS username, CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '@mail.example.com' ELSE c_name || '@corp.example.com' END AS email,
        CASE WHEN c_acctbal < 0 THEN c_name ELSE c_mktsegment END AS nickname,
        CASE WHEN c_acctbal >= 0 THEN t.name ELSE '' END AS teams
    FROM people p JOIN graph_teams t ON p.n_regionkey = t.r_regionkey WHERE c_acctbal > -900""",
)
add(
    "entity_posts",
    """SELECT t_idx, row_number() OVER (ORDER BY t_idx, c_idx, p_idx) - 1 AS place,
        team_name, channel_name, username, message, timestamp_ms, id, parent_id,
        array_to_string(list_transform(attachments, lambda a: a.path), ',') AS files FROM posts""",
)
add(
    "entity_summary",
    " UNION ALL ".join(
        f"SELECT '{name}' AS entity, count(*) AS found FROM {name}"
        for name in ("users", "user_teams", "teams", "team_people", "channels", "channel_people", "direct_channels", "direct_posts")
    )
    + " UNION ALL SELECT 'dangling', 0",
)
add("graph_teams", "SELECT group_id, name, display_name, description FROM graph_teams")
add(
    "graph_channels",
    """SELECT c.team_name, c.name, c.is_private, count_if(p.c_acctbal >= 0) AS members, count_if(p.c_acctbal > 9000) AS owners
    FROM graph_channels c JOIN people p ON p.n_regionkey = c.n_regionkey GROUP BY ALL""",
)
add(
    "graph_posts",
    """SELECT team_name, g.name AS channel_name, c_name AS username,
        CASE WHEN o_totalprice > 20000 THEN o_orderpriority ELSE '' END AS message,
        CASE WHEN o_orderpriority <> '5-LOW' THEN epoch_ms(o_orderdate) ELSE 0 END AS timestamp_ms, 'm' || o_orderkey AS id,
        CASE WHEN o_orderstatus = 'F' THEN 'm' || (o_orderkey - 25) END AS parent_id,
        CASE WHEN o_orderpriority <> '2-HIGH' THEN '' WHEN o_totalprice > 250000 THEN 'note.pdf|note.pdf|https://files.example.com/' || o_orderkey
            ELSE 'file|file|https://files.example.com/' || o_orderkey END AS files
    FROM sold JOIN graph_channels g ON c_nationkey = n_nationkey WHERE o_orderstatus <> 'P'""",
)
add(
    "graph_chats",
    """SELECT string_agg(CASE WHEN longest >= 120 THEN role END, ',' ORDER BY first) AS members, sum(n)::BIGINT AS posts,
        epoch_ms(TIMESTAMP '2024-01-02 01:04:05') AS last_ms, conv_id
    FROM (SELECT conv_id, role, max(length(text)) AS longest, min(turn) AS first, count(*) AS n FROM conversations GROUP BY ALL)
    GROUP BY conv_id HAVING count_if(longest >= 120) >= 2""",
)
FLAT = "type, name, place, author, content, create_at, root_id"
add("payload_jsonl", f"SELECT {FLAT} FROM flat")
add("all_records", f"SELECT {FLAT} FROM flat")
add(
    "rollback_targets",
    "SELECT 'team' AS kind, team_slug AS name FROM team_map UNION ALL SELECT 'channel', channel_slug FROM channel_map",
)
add("attachment_manifest", "SELECT * FROM manifest")
add("attachment_outcome", "SELECT * FROM outcome")

# --- scalar functions ----------------------------------------------------------------

add("slugify", f"SELECT doc_id, {slug('text')} AS slug FROM documents")
add("stable_alias", f"SELECT c_custkey, {alias('c_name')} AS alias FROM customer")
add("source_post_key", "SELECT p_idx, source_key FROM keyed")
add(
    "post_import_id",
    f"""SELECT p_idx, 'post-' || {hmac("concat_ws('|', team_slug, channel_slug, source_key)")} AS import_id
    FROM keyed JOIN team_map USING (team_name) JOIN channel_map USING (team_name, channel_name)""",
)
add("direct_post_id", 'SELECT d_idx, p_idx, idx AS "index", id FROM direct_ranked')
add("email_norm", "SELECT u_idx, lower(email) AS email FROM users")
add(
    "username_resolve",
    f"""SELECT p_idx, p.username, coalesce(slug, {slug('p.username')}) AS plain, {alias('p.username')} AS masked
    FROM posts p LEFT JOIN user_map m ON p.username = m.username""",
)
add(
    "attachment_name",
    """SELECT page_id, substr(sha256(url), 1, 8) || '_' || CASE WHEN base = '' THEN 'file' ELSE base END AS file_id FROM (
        SELECT page_id, url, regexp_replace(split_part(regexp_replace(url, '(/+\\.?)+$', ''), '/', -1), '[^a-zA-Z0-9.-]+', '_', 'g') AS base
        FROM pages)""",
)
BLOCK = "regexp_matches(lower(message), 'confidential|secret|restricted')"
add(
    "keyword_scrub",
    f"SELECT doc_id, CASE WHEN {BLOCK} THEN '{BLOCKED_TEXT}' ELSE message END AS message FROM messages",
)


def redacted(text: str, *names: str) -> str:
    for name, pattern, marker in REDACTIONS:
        if not names or name in names:
            text = f"regexp_replace({text}, '{pattern}', '{marker}', 'g')"
    return text


for _rule, _, _ in REDACTIONS:
    add(f"redact_{_rule}", f"SELECT doc_id, {redacted('message', _rule)} AS message FROM messages")

# Every name is one word here, so names are looked up word by word; the gaps stay.
_WORD = r"[\p{L}\p{N}_\p{M}]"


def renamed(source: str) -> str:
    return f"""SELECT doc_id, string_agg(coalesce(alias, part), '' ORDER BY pos) AS message FROM (
            SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (
                SELECT doc_id, regexp_extract_all(message, '{_WORD}+|{_WORD.replace('[', '[^')}+') AS parts FROM ({source})))
        LEFT JOIN (SELECT lower(username) AS word, arg_min(alias, rank) AS alias FROM names GROUP BY 1) n ON n.word = lower(part)
        GROUP BY doc_id"""


add("redact_usernames", renamed("SELECT doc_id, message FROM messages"))
# The added users come last and after one another.
_FIRST = "(SELECT arg_min(alias, rank) FROM names)"
_SELF = alias("'user'")
add(
    "redact_usernames_nested",
    f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(message,
            '\\b' || {_FIRST} || '\\b', {alias(_FIRST)}, 'g'),
            '(?i)\\buser\\b', {_SELF}, 'g'),
            '\\b' || {_SELF}[6:] || '\\b', {alias(f"{_SELF}[6:]")}, 'g') AS message
        FROM ({renamed("SELECT doc_id, message FROM messages")})""",
)
add(
    "anonymize_text",
    f"""{renamed(f"SELECT doc_id, {redacted('message')} AS message FROM messages WHERE NOT {BLOCK}")}
    UNION ALL SELECT doc_id, '{BLOCKED_TEXT}' FROM messages WHERE {BLOCK}""",
)
add(
    "iso_to_epoch_ms",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN epoch_us(ts - INTERVAL 330 MINUTE) // 1000
        ELSE epoch_us(ts) // 1000 END AS ms FROM events""",
)
add("upn_local_part", "SELECT u_idx, split_part(email, '@', 1) AS username FROM users")
add(
    "member_key",
    "SELECT d_idx, coalesce(list_aggregate(list_sort(members), 'string_agg', ','), '') AS key FROM direct_channels",
)
add(
    "user_auth",
    """SELECT u_idx, slug AS username, lower(email) AS email, nickname, 'saml' AS auth_service, email AS auth_data
    FROM users JOIN user_map USING (username)""",
)
for _name, _data in (("masked", f"{alias('username')} || '@example.invalid'"), ("unmasked", "email")):
    add(
        f"user_auth_{_name}",
        f"""SELECT u_idx, {alias('username')} AS username, {alias('username')} || '@example.invalid' AS email,
            'Anonymized User' AS nickname, 'ldap' AS auth_service, {_data} AS auth_data FROM users""",
    )

# --- validation ----------------------------------------------------------------------

RULES: dict[str, str] = {}
KNOWN = f"(SELECT {slug('username')} FROM users)"
PLACE = "2.' || t_idx || '.2.' || c_idx || '.1.' || p_idx || '."


def rule(query: str, name: str, text: str) -> None:
    RULES[query] = text.replace("RULE", f"'{name}'")


rule(
    "dup_users",
    "duplicate_user",
    f"""SELECT RULE AS rule, '1.' || u_idx || '.0.0.0.0.0' AS place, 'duplicate username after normalization: ' || username AS message,
        1 AS phase, u_idx AS a, 0 AS sa, 0 AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM (SELECT *, row_number() OVER (PARTITION BY {slug('username')} ORDER BY u_idx) AS n FROM users) WHERE n > 1""",
)
rule(
    "team_member_missing",
    "team_member_missing",
    f"""SELECT DISTINCT RULE AS rule, '2.' || t_idx || '.1.0.0.0.0' AS place,
        'team member ''' || username || ''' in team ''' || team_name || ''' is missing from users' AS message,
        2 AS phase, t_idx AS a, 1 AS sa, 0 AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM team_people WHERE {slug('username')} NOT IN {KNOWN}""",
)
rule(
    "dup_posts",
    "duplicate_post",
    f"""SELECT RULE AS rule, '{PLACE}0' AS place, 'duplicate post id in channel ''' || channel_name || ''': ' || id AS message,
        2 AS phase, t_idx AS a, 2 AS sa, c_idx AS b, 1 AS sb, p_idx AS c, 0 AS sc
    FROM (SELECT *, row_number() OVER (PARTITION BY t_idx, c_idx, id ORDER BY p_idx) AS n FROM posts WHERE id IS NOT NULL) WHERE n > 1""",
)
rule(
    "post_author_missing",
    "post_author_missing",
    f"""SELECT RULE AS rule, '{PLACE}1' AS place,
        'post author ''' || username || ''' in channel ''' || channel_name || ''' is missing from users' AS message,
        2 AS phase, t_idx AS a, 2 AS sa, c_idx AS b, 1 AS sb, p_idx AS c, 1 AS sc
    FROM posts WHERE {slug('username')} NOT IN {KNOWN}""",
)
rule(
    "reply_parent_unknown",
    "reply_parent_unknown",
    f"""SELECT RULE AS rule, '{PLACE}2' AS place, 'post reply ''' || coalesce(p.id, p.username) || ''' in channel '''
        || channel_name || ''' references unknown parent ''' || p.parent_id || '''' AS message,
        2 AS phase, t_idx AS a, 2 AS sa, c_idx AS b, 1 AS sb, p_idx AS c, 2 AS sc
    FROM posts p LEFT JOIN (SELECT c_idx AS fc, id AS fid, min(p_idx) AS first FROM posts WHERE id IS NOT NULL GROUP BY ALL) f
        ON fc = p.c_idx AND fid = p.parent_id
    WHERE p.parent_id IS NOT NULL AND (first IS NULL OR first > p.p_idx)""",
)
rule(
    "user_unknown_teams",
    "user_unknown_teams",
    f"""SELECT RULE AS rule, '3.' || first || '.0.0.0.0.0' AS place,
        'user ''' || s || ''' references unknown teams: [''' || string_agg(DISTINCT team, ''', ''' ORDER BY team) || ''']' AS message,
        3 AS phase, first AS a, 0 AS sa, 0 AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM (SELECT {slug('username')} AS s, min(u_idx) AS first, max(u_idx) AS last FROM users GROUP BY 1) u
    JOIN (SELECT u_idx, {slug('team_name')} AS team FROM user_teams) t ON t.u_idx = u.last
    WHERE team NOT IN (SELECT {slug('name')} FROM teams) GROUP BY s, first""",
)
rule(
    "dm_arity",
    "direct_channel_size",
    """SELECT RULE AS rule, '4.' || d_idx || '.0.0.0.0.0' AS place,
        'direct channel has invalid member count: ' || len(members) || ' (minimum 2 required)' AS message,
        4 AS phase, d_idx AS a, 0 AS sa, 0 AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM direct_channels WHERE len(members) < 2""",
)
rule(
    "dm_member_missing",
    "direct_member_missing",
    f"""SELECT RULE AS rule, '4.' || d_idx || '.1.' || pos || '.0.0.0' AS place,
        'direct channel member ''' || name || ''' is missing from users' AS message,
        4 AS phase, d_idx AS a, 1 AS sa, pos AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM (SELECT d_idx, unnest(members) AS name, generate_subscripts(members, 1) - 1 AS pos FROM direct_channels)
    WHERE {slug('name')} NOT IN {KNOWN}""",
)
rule(
    "dm_author_missing",
    "direct_author_missing",
    f"""SELECT RULE AS rule, '4.' || d_idx || '.2.' || p_idx || '.0.0.0' AS place,
        'direct post author ''' || username || ''' in DM channel is missing from users' AS message,
        4 AS phase, d_idx AS a, 2 AS sa, p_idx AS b, 0 AS sb, 0 AS c, 0 AS sc
    FROM direct_posts WHERE {slug('username')} NOT IN {KNOWN}""",
)
for _name, _text in RULES.items():
    add(_name, f"SELECT rule, place, message FROM ({_text})")
FOUND = " UNION ALL ".join(RULES.values())
add("validation_violations", f"SELECT rule, count(*) AS found FROM ({FOUND}) GROUP BY rule")
add(
    "validation_report",
    f"""SELECT rule, place, message FROM ({FOUND}) ORDER BY phase, a, sa, b, sb, c, sc, message LIMIT 20""",
)
add(
    "dup_teams",
    f"""SELECT 'duplicate_team' AS rule, '2.' || p_partkey || '.0.0.0.0.0' AS place,
        'duplicate team name after normalization: ' || p_name AS message
    FROM (SELECT *, row_number() OVER (PARTITION BY {slug('p_name')} ORDER BY p_partkey) AS n FROM part) WHERE n > 1""",
)
add(
    "dup_channels",
    f"""SELECT 'duplicate_channel' AS rule, '2.' || p_size || '.2.' || p_partkey || '.0.0.0' AS place,
        'duplicate channel name in team ''Size ' || p_size || ''' after normalization: ' || p_type AS message
    FROM (SELECT *, row_number() OVER (PARTITION BY p_size, {slug('p_type')} ORDER BY p_partkey) AS n FROM part) WHERE n > 1""",
)
add(
    "channel_member_missing",
    f"""SELECT DISTINCT 'channel_member_missing' AS rule, '2.' || t_idx || '.2.' || c_idx || '.2.0.0' AS place,
        'channel member ''' || s_name || ''' in channel ''' || name || ''' is missing from users' AS message
    FROM supplier JOIN channels ON s_nationkey = c_idx WHERE {slug('s_name')} NOT IN {KNOWN}""",
)
add(
    "empty_export",
    "SELECT 'bare' AS workspace, 'empty_export' AS rule, 'input export must contain at least one team and one user' AS message "
    "WHERE (SELECT count(*) FROM users) > 0",
)
COUNTS = ", ".join(
    f"(SELECT count(*) FROM {t}) AS {t}" for t in ("teams", "channels", "users", "posts", "direct_channels", "direct_posts")
)
add("validation_summary", f"SELECT {COUNTS}")
add(
    "validation_slugs",
    f"SELECT DISTINCT 'team' AS kind, {slug('name')} AS slug FROM teams UNION SELECT DISTINCT 'user', {slug('username')} FROM users",
)

# --- naming --------------------------------------------------------------------------

add(
    "unique_slugs",
    f"""SELECT p_partkey, p_name, base || CASE WHEN n = 1 THEN '' ELSE '-' || (n - 1) END AS slug FROM (
        SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS n FROM (SELECT *, {slug('p_name')} AS base FROM part))""",
)
# Row after row: the first unused name. The n-th row of a base takes suffix n - 1 or, past the
# names that rivals hold, at most one more for each of them.
add(
    "unique_slugs_rivals",
    "SELECT p_partkey, name, slug FROM rival_walk JOIN rival_choices USING (i)",
    {
        "rival_based": f"""
            SELECT *, {slug('name')} AS base, row_number() OVER (ORDER BY p_partkey) AS i FROM (
                SELECT p_partkey, CASE WHEN p_size > 25 THEN 'Brand'
                    WHEN p_size > 20 THEN 'Brand#' || p_size || ' ' || (p_partkey % 7) ELSE p_brand END AS name FROM part)""",
        "rival_numbers": """
            SELECT regexp_extract(base, '^(.+)-[1-9][0-9]*$', 1) AS base, count(DISTINCT base) AS rivals
            FROM rival_based GROUP BY 1""",
        "rival_choices": """
            SELECT i, p_partkey, name, list_transform(range(n - 1, n + 1 + coalesce(rivals, 0)),
                lambda k: CASE WHEN k = 0 THEN base ELSE base || '-' || k END) AS choice
            FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY i) AS n FROM rival_based)
            LEFT JOIN rival_numbers USING (base)""",
        "rival_walk": """
            SELECT 0::BIGINT AS i, []::VARCHAR[] AS taken, ''::VARCHAR AS slug
            UNION ALL
            SELECT i, list_append(taken, slug), slug FROM (
                SELECT c.i, w.taken, list_filter(c.choice, lambda x: NOT list_contains(w.taken, x))[1] AS slug
                FROM rival_walk w JOIN rival_choices c ON c.i = w.i + 1)""",
    },
)
for _name, _users in (
    ("slug_maps", "SELECT 'user' AS kind, NULL AS scope, username AS name, slug FROM user_map"),
    ("slug_maps_masked", f"SELECT DISTINCT 'user' AS kind, NULL AS scope, username AS name, {alias('username')} AS slug FROM users"),
):
    add(
        _name,
        f"""{_users} UNION ALL SELECT 'team', NULL, team_name, team_slug FROM team_map
        UNION ALL SELECT 'channel', team_name, channel_name, channel_slug FROM channel_map""",
    )

# --- membership ----------------------------------------------------------------------

add("user_teams", "SELECT username, team_name FROM pairs")
add("team_roles", "SELECT username, team_name, roles FROM t_roles")
add("channel_visibility", "SELECT username, team_name, channel_name FROM c_roles")
add("channel_roles", "SELECT username, team_name, channel_name, roles FROM c_roles")
add("memberships", "SELECT username, teams FROM nested")

# --- records -------------------------------------------------------------------------

add(
    "team_records",
    "SELECT t_idx, team_slug AS name, display_name, description, 'O' AS type FROM teams JOIN team_map ON name = team_name",
)
add(
    "channel_records",
    """SELECT t_idx, c_idx, team_slug AS team, channel_slug AS name, display_name, 'Migrated from Teams: ' || display_name AS header,
        CASE WHEN is_private THEN 'P' ELSE 'O' END AS type
    FROM channels JOIN team_map USING (team_name) JOIN channel_map ON channels.name = channel_name""",
)
add(
    "user_records",
    """SELECT u_idx, slug AS username, lower(email) AS email, nickname, 'saml' AS auth_service, slug AS auth_data,
        coalesce(teams, '') AS teams
    FROM users u JOIN user_map m ON u.username = m.username LEFT JOIN nested n ON n.username = u.username""",
)
RAW_POST = f"""SELECT p.p_idx, import_id AS id, team_slug AS team, channel_slug AS channel, %s AS "user", %s AS message,
    timestamp_ms AS create_at, root_id, d.attachments, d.file_ids
    FROM import_posts p LEFT JOIN user_map m ON p.username = m.username LEFT JOIN delivered d ON d.p_idx = p.p_idx"""
add("post_records", RAW_POST % (f"coalesce(slug, {slug('p.username')})", "message"))
# A post names one customer at its end; that name becomes the alias when it is a username.
add(
    "post_records_masked",
    RAW_POST.replace("LEFT JOIN delivered", "LEFT JOIN (SELECT DISTINCT username AS known FROM users) k ON k.known = split_part(message, ' for ', 2) LEFT JOIN delivered")
    % (
        alias("p.username"),
        f"""CASE WHEN known IS NULL THEN message
            ELSE split_part(message, ' for ', 1) || ' for ' || {alias('known')} END""",
    ),
)
add(
    "direct_channel_records",
    "SELECT d_idx, coalesce(members, '') AS members FROM (SELECT d_idx FROM direct_channels) LEFT JOIN members USING (d_idx)",
)
add(
    "direct_post_records",
    f"""SELECT p.d_idx, p_idx, idx AS "index", id, coalesce(c.members, '') AS channel_members, coalesce(slug, {slug('p.username')}) AS "user",
        message, timestamp_ms AS create_at
    FROM direct_ranked p LEFT JOIN members c ON p.d_idx = c.d_idx LEFT JOIN user_map m ON p.username = m.username""",
)
add(
    "direct_post_records_masked",
    f"""SELECT p.d_idx, p_idx, idx AS "index", id, coalesce(c.members, '') AS channel_members, {alias('p.username')} AS "user",
        CASE WHEN {BLOCK} THEN '{BLOCKED_TEXT}' ELSE {redacted('message')} END AS message, timestamp_ms AS create_at
    FROM direct_ranked p LEFT JOIN members_masked c ON p.d_idx = c.d_idx""",
)

# --- threads -------------------------------------------------------------------------

add("thread_roots", "SELECT t_idx, c_idx, source_key, root FROM roots")
add(
    "thread_order",
    """SELECT c_idx, p_idx, root_ts, root_key, row_number() OVER (PARTITION BY t_idx, c_idx
        ORDER BY root_ts, root_key, (source_key <> root_key)::INT, timestamp_ms, p_idx) - 1 AS position FROM threaded""",
)
add("thread_root_id", "SELECT p_idx, root_id FROM import_posts")
add(
    "orphan_replies",
    """SELECT team_name, channel_name, id AS post_id, parent_id, p_idx FROM threaded
    WHERE parent_id IS NOT NULL AND (NOT root_exists OR root_key = source_key)""",
)

# --- resume --------------------------------------------------------------------------

CUT = 852076800000
DONE = f"SELECT * FROM flat WHERE coalesce(create_at, 0) < {CUT}"
# Direct channels are compared by their members in any order.
add(
    "resume_entities",
    f"""SELECT {FLAT} FROM flat f WHERE type <> 'version' AND NOT EXISTS (
        SELECT 1 FROM ({DONE}) d WHERE d.type = f.type AND d.name = f.name)""",
)
SCOPED = f"""
    SELECT f.*, CASE WHEN type = 'post' THEN place ELSE coalesce(list_aggregate(list_sort(string_split(m.members, ',')), 'string_agg', ','), '') END AS scope
    FROM flat f LEFT JOIN members m ON type = 'direct_post' AND m.d_idx = f.c_idx WHERE type IN ('post', 'direct_post')"""
STATE = """
    SELECT DISTINCT s.type, s.scope, s.create_at AS last_ts, s.name AS id FROM {src} s
    JOIN (SELECT type, scope, max(create_at) AS m FROM {src} GROUP BY ALL) x
    ON s.type = x.type AND s.scope = x.scope AND s.create_at = x.m"""
add("resume_state", STATE.format(src="scoped"), {"scoped": SCOPED})
# The cut leaves no direct post, and channels are written one after another by position.
LEFT_BEHIND = """SELECT type, scope FROM (SELECT type, scope, max(c_idx) AS c FROM cut GROUP BY ALL)
    WHERE c < (SELECT max(t * 100 + c) % 100 FROM (SELECT DISTINCT channels.t_idx AS t, channels.c_idx AS c FROM channels JOIN cut ON cut.c_idx = channels.c_idx))
    OR c <> (SELECT max(t * 100 + c) % 100 FROM (SELECT DISTINCT channels.t_idx AS t, channels.c_idx AS c FROM channels JOIN cut ON cut.c_idx = channels.c_idx))"""
CUT_PARTS = {"scoped": SCOPED, "cut": f"SELECT * FROM scoped WHERE create_at < {CUT}"}
add("finished_channels", LEFT_BEHIND, CUT_PARTS)
add(
    "resume_posts",
    f"""SELECT {FLAT} FROM scoped s
    WHERE (type, scope) NOT IN ({LEFT_BEHIND})
    AND create_at >= coalesce((SELECT max(last_ts) FROM state x WHERE x.type = s.type AND x.scope = s.scope), 0)
    AND NOT EXISTS (SELECT 1 FROM state x WHERE x.type = s.type AND x.scope = s.scope AND x.last_ts = s.create_at AND x.id = s.name)""",
    {**CUT_PARTS, "state": STATE.format(src="cut")},
)
add("record_stats", "SELECT type, count(*) AS records FROM flat GROUP BY type")

add("resume_state_batches", STATE.format(src="scoped"), {"scoped": SCOPED})
UNWRITTEN = f"type <> 'version' AND NOT EXISTS (SELECT 1 FROM ({DONE}) d WHERE d.type = f.type AND d.name = f.name)"
add("resume_payload", f"SELECT {FLAT} FROM flat f WHERE coalesce(create_at, 0) < {CUT} OR ({UNWRITTEN})")
add(
    "resume_gate",
    f"""SELECT 'with manifest' AS payload, true AS resumed, type, count(*) AS records FROM flat f WHERE {UNWRITTEN} GROUP BY type
    UNION ALL SELECT payload, false, type, count(*) FROM flat, (VALUES ('no manifest'), ('no payload')) p(payload) GROUP BY ALL""",
)

# --- after the import ----------------------------------------------------------------

KEPT = """
    SELECT id, createat, props FROM (SELECT *, row_number() OVER (PARTITION BY props LIKE '%"import_id"%',
        CASE WHEN props LIKE '%"import_id"%' THEN nullif(regexp_extract(props, '"import_id"\\s*:\\s*"([^"]+)"', 1), '') ELSE id::VARCHAR || ' none' END
        ORDER BY createat, id) AS n FROM {src}) WHERE n = 1"""
add("dedupe_import", KEPT.format(src="target_posts"))
add(
    "verify_counts",
    """SELECT (SELECT count(*) FROM teams) AS teams, (SELECT count(*) FROM channels) AS channels, (SELECT count(*) FROM users) AS users,
        (SELECT count(*) FROM target_posts) AS posts, (SELECT count(*) FROM target_posts) > 0 AS healthy""",
)
add(
    "import_idempotent",
    f"""SELECT (SELECT count(*) FROM ({KEPT.format(src='target_posts')})) AS posts, 'once' AS imports
    UNION ALL SELECT (SELECT count(*) FROM ({KEPT.format(src='doubled')})), 'twice'""",
    {
        "doubled": """SELECT * FROM target_posts UNION ALL SELECT id + (SELECT max(id) + 1 FROM target_posts), createat + 1, props
            FROM target_posts WHERE props LIKE '%"import_id"%'"""
    },
)

# --- monitoring ----------------------------------------------------------------------

add("metric_counters", "SELECT event_type, user_id, count(*) AS total FROM events GROUP BY ALL")
_BOUNDS = ", ".join(
    f"({b}, '{b:g}')" if b != int(b) else f"({b}, '{b:.1f}')" for b in DURATION_BOUNDS
)
add(
    "stage_histogram",
    f"""SELECT event_type, le, count_if(value / 10 <= bound) AS bucket, count(*) AS total,
        round(sum((value / 10)::DECIMAL(38, 6))::DOUBLE, 4) AS seconds
    FROM events, (VALUES {_BOUNDS}, ('inf'::DOUBLE, '+Inf')) b(bound, le) GROUP BY event_type, le""",
)
add(
    "throughput",
    """SELECT user_id, arg_max(k, (ts, event_id)) AS last_run_records,
        round(arg_max(k / secs, (ts, event_id)) FILTER (secs > 0), 6) AS records_per_second
    FROM (SELECT *, (props->>'k')::BIGINT AS k, floor(value)::BIGINT AS secs FROM events) GROUP BY user_id""",
)


def minute_after(column: str) -> str:
    return f"make_timestamp((ceil(epoch({column}) / 60) * 60 * 1000000)::BIGINT)"


def increases(minutes: int, where: str) -> str:
    """Steps seen at each whole minute of the span that holds both samples."""
    return f"""SELECT container, minute, sum(step) AS increase FROM (
        SELECT container, step, unnest(generate_series({minute_after('ts')},
            {minute_after('prev_ts')} + INTERVAL {minutes - 1} MINUTE, INTERVAL 1 MINUTE)) AS minute
        FROM steps WHERE {where}) GROUP BY container, minute"""


add("counter_increase", f"SELECT container, minute, increase FROM ({increases(15, 'true')}) WHERE increase > 0")
add(
    "rate_by_label",
    f"""SELECT container, minute, round(increase / 3600, 6) AS rate FROM ({increases(60, "container <> ''")})""",
)
add(
    "gauge_sum_by_label",
    """SELECT container, sum(v::DECIMAL(38, 6))::DOUBLE AS value FROM (
        SELECT series, container, arg_max(gauge, (ts, event_id)) AS v FROM samples WHERE container <> '' GROUP BY ALL) GROUP BY container""",
)
add(
    "sustained_alert",
    """SELECT series, container, min(ts) AS since, max(ts) AS until, min(ts) + INTERVAL 5 MINUTE AS fires_at FROM (
        SELECT *, sum((NOT down)::INT) OVER (PARTITION BY series, container ORDER BY ts, event_id) AS stretch FROM samples)
    WHERE down GROUP BY series, container, stretch HAVING max(ts) >= min(ts) + INTERVAL 5 MINUTE""",
)
# A stream has handed on what its watermark has passed: all but the last days.
_PASSED = "(SELECT max(ts) FROM samples) - INTERVAL 12 DAY"
add(
    "stream_counter_steps",
    f"SELECT series || '/' || container AS series, ts, step FROM steps WHERE ts <= {_PASSED}",
)


def held(end: str) -> str:
    """Runs of samples that are down, up to the next sample that is not."""
    return f"""SELECT series, container, since, since + INTERVAL 6 HOUR AS fires_at FROM (
        SELECT series, container, min(ts) FILTER (down) AS since,
            lead(min(ts) FILTER (NOT down)) OVER (PARTITION BY series, container ORDER BY stretch) AS ended
        FROM (SELECT *, sum((NOT down)::INT) OVER (PARTITION BY series, container ORDER BY ts, event_id) AS stretch
            FROM samples WHERE ts <= {end})
        GROUP BY series, container, stretch)
    WHERE since + INTERVAL 6 HOUR <= {end} AND (ended IS NULL OR ended > since + INTERVAL 6 HOUR)"""


add("stream_held_alert", f"SELECT series || '/' || container AS series, since, fires_at FROM ({held(_PASSED)})")
add("held_alert", held("(SELECT max(ts) FROM samples)"))
add(
    "select_series",
    "SELECT event_id, ts, 'memory_bytes' AS metric, gauge AS value, series FROM samples WHERE container = 'click'",
)
add(
    "log_select",
    """SELECT event_id AS line_no, service || '-1' AS container, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, 'ERROR' AS level,
        'job' AS logger, service, 'run-' || user_id AS correlation_id, 'error handled' AS message, 'run_failed' AS event, props->>'k' AS details
    FROM (SELECT *, CASE WHEN value < 20 THEN 'postgres' WHEN value < 60 THEN 'chat-server' ELSE 'other' END AS service FROM events)
    WHERE event_type = 'error' AND service <> 'other'""",
)

# --- job -----------------------------------------------------------------------------

add(
    "run_summary",
    """SELECT 0 AS bytes, (SELECT count(*) FROM teams) AS teams, (SELECT count(*) FROM channels) AS channels, (SELECT count(*) FROM users) AS users,
        (SELECT count(*) FROM posts) AS posts, (SELECT count(*) FROM flat) AS records""",
)
