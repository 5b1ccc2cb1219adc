"""Small workspaces for tests, and plain-Python models to compare with."""

import hashlib
import hmac
import re

from chatloom.functions.hashing import DEFAULT_SALT
from chatloom.plans.workspace import SCHEMAS, Workspace


def make_workspace(spark, **rows):
    tables = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    return Workspace(**tables)


def post(p_idx, username, message, ts, id=None, parent=None, files=(), team="it-team", channel="general", t=0, c=0):
    return (t, c, p_idx, team, channel, username, message, ts, id, parent, list(files))


def slug_model(value):
    if not value:
        return "default-slug"
    words = re.findall("[a-z0-9]+", value.lower())
    return "-".join(words) or "fallback-" + hashlib.sha256(value.encode()).hexdigest()[:10]


def keyed(text, salt=DEFAULT_SALT):
    return hmac.new(salt.encode(), text.encode(), hashlib.sha256).hexdigest()[:12]


def unique_model(values):
    used, result = set(), []
    for value in values:
        base = name = slug_model(value)
        number = 0
        while name in used:
            number += 1
            name = f"{base}-{number}"
        used.add(name)
        result.append(name)
    return result


def root_model(parents, start):
    seen, here = [start], start
    while parents.get(here) and parents[here] not in seen:
        here = parents[here]
        seen.append(here)
    return here
