"""Row-by-row statements of the write semantics, for small inputs."""

from __future__ import annotations

from collections import Counter


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def upsert(target, source, key, part=None):
    """Rows are dicts. Returns the expected bag, or None when a target row matches twice."""
    scope = {r[part] for r in source if r[part] is not None} if part else None

    def matches(t, s):
        return s[key] is not None and s[key] == t[key] and (part is None or t[part] in scope)

    out = []
    for t in target:
        hits = [s for s in source if matches(t, s)]
        if len(hits) > 1:
            return None
        out.append(hits[0] if hits else t)
    out += [s for s in source if not any(matches(t, s) for t in target)]
    return Counter(tuple(r.values()) for r in out)


def replace(target, source, part, where):
    scope = {r[part] for r in source if r[part] is not None}
    kept = [t for t in target if not (where(t) and t[part] in scope)]
    return Counter(tuple(r.values()) for r in kept + source)
