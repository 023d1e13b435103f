"""Small tables for the tests, and brute-force versions of the operators."""

import re

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra: str = ""):
    """rows: (doc_id, text) or whole tuples; ``extra`` adds a column of that
    name, to clash with names that operators use inside."""
    full = [(*r, None, None, None)[:5] if len(r) == 2 else r for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in extra.split():
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def link_components(fps: dict, bits: int = 3) -> dict:
    parent = {k: k for k in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def dedup_lines(docs: list, min_chars: int) -> dict:
    """docs: (doc_id, text) in order of occurrence."""
    seen, gone = set(), {d: set() for d, _ in docs}
    for d, text in docs:
        lines = [(i, x) for i, x in enumerate((text or "").split("\n")) if x.strip(" ")]
        for p in range(len(lines)):
            for q in range(p, len(lines)):
                run = tuple(x for _, x in lines[p : q + 1])
                if sum(map(len, run)) >= min_chars:
                    if run in seen:
                        gone[d] |= {i for i, _ in lines[p : q + 1]}
                    seen.add(run)
    out = {}
    for d, text in docs:
        if text is None or not gone[d]:
            out[d] = text
        else:
            kept = [x for i, x in enumerate(text.split("\n")) if i not in gone[d]]
            out[d] = "\n".join(kept) if any(x.strip(" ") for x in kept) else ""
    return out
