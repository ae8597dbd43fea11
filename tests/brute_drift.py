"""Schema drift by plain loops, to hold the operator against."""

from __future__ import annotations

import json
from collections import Counter, defaultdict


def tag(v):
    return None if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def record(o):
    ip = o.get("ip_address")
    if o.get("urlhaus_id") not in (None, ""):
        return "u", str(o["urlhaus_id"]).strip()
    if ip:
        ip = ip.strip().lower()
        return "i", ip[7:] if ip.startswith("::ffff:") else ip
    if o.get("cve_id"):
        return "c", o["cve_id"].strip().upper()
    return ("s", o["session"].strip()) if o.get("session") else None


def changes(lines):
    """lines: (file_id, source, host, collected_at, payload)."""
    files, groups = {}, defaultdict(list)
    for f, s, h, at, p in lines:
        try:
            o = json.loads(p) if p is not None else None
        except ValueError:
            continue
        if isinstance(o, dict):
            files.setdefault(f, (s, h, at, []))[3].append(o)
    for f, (s, h, at, rows) in files.items():
        groups[s, h].append((at, f, rows))
    out = set()
    for group in groups.values():
        before, had = None, {}
        for _, f, rows in sorted(group, key=lambda x: x[:2]):
            n = Counter(k for o in rows for k in o)
            types = defaultdict(Counter)
            for o in rows:
                for k, v in o.items():
                    if v is not None:
                        types[k][tag(v)] += 1
            schema = {}
            for k, c in n.items():
                if c * 2 > len(rows):
                    best = max(((m, t) for t, m in types[k].items()), default=None)
                    had[k] = schema[k] = best[1] if best else had.get(k)
            values = defaultdict(lambda: defaultdict(set))
            for o in rows:
                if (r := record(o)) is not None:
                    for k, v in o.items():
                        if v is not None:
                            values[k][r].add((tag(v), json.dumps(float(v) if tag(v) == "number" else v, sort_keys=True)))
            if before is not None:
                old_schema, old_values = before
                gone, come = set(old_schema) - set(schema), set(schema) - set(old_schema)
                like = []
                for a in gone:
                    for b in come:
                        both = set(old_values[a]) & set(values[b])
                        eq = sum(bool(old_values[a][r] & values[b][r]) for r in both)
                        if eq * 2 > len(both):
                            like.append((-eq / len(both), -eq, a, b))
                best_a, best_b = {}, {}
                for s, e, a, b in sorted(like):
                    best_a.setdefault(a, b)
                for s, e, a, b in sorted(like, key=lambda x: (x[0], x[1], x[3], x[2])):
                    best_b.setdefault(b, a)
                for a, b in best_a.items():
                    if best_b[b] == a:
                        out.add((f, "renamed", a, b))
                        gone.discard(a)
                        come.discard(b)
                out |= {(f, "removed", a, "") for a in gone} | {(f, "added", "", b) for b in come}
                out |= {(f, "retyped", k, k) for k in set(schema) & set(old_schema) if schema[k] != old_schema[k] and schema[k] and old_schema[k]}
            before = schema, values
    return out
