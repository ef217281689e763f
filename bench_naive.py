"""The same questions answered by plain single-process Python, as a baseline: seconds with reading, over $BENCH_SF_DIR.

Rows are dictionaries and tables are lists, as in a script without an engine;
results are held against nothing here, the queries themselves are held against SQL.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import os
import re
import time
import unicodedata
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pyarrow.parquet as pq

from colloquy.plans.registry import CONTEXT, CUTOFF, KEYWORDS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def read(name: str, *columns: str) -> list[dict]:
    return pq.read_table(f"{SF_DIR}/{name}.parquet", columns=list(columns) or None).to_pylist()


def context_enrich_branch():
    rows = {(r["conv_id"], r["turn"]): r for r in read("conversations")}
    out = []
    for (conv, turn), _ in rows.items():
        up, at = [], (turn - 1) // 2 if turn else None
        while at is not None and at not in up and (conv, at) in rows:
            up.insert(0, at)
            at = (at - 1) // 2 if at else None
        out.append((conv, turn, len(up), ">".join(map(str, up)), "\n".join(f"{rows[conv, a]['role']}: {rows[conv, a]['text']}" for a in up[-CONTEXT:])))
    return out


def depth_stack_parent():
    out, now, stack = [], None, {}
    for r in sorted(read("conversations", "conv_id", "turn"), key=lambda r: (r["conv_id"], r["turn"])):
        if r["conv_id"] != now:
            now, stack = r["conv_id"], {}
        d = (r["turn"] + 1).bit_length() - 1
        out.append((now, r["turn"], stack.get(d - 1, "") if d else "post"))
        stack = {k: v for k, v in stack.items() if k < d} | {d: r["turn"]}
    return out


def chunk_by_thread():
    threads = defaultdict(list)
    for r in sorted(read("conversations"), key=lambda r: (r["conv_id"], r["turn"])):
        threads[r["conv_id"]].append(r)
    return [(c, t[k : k + 3]) for c, t in threads.items() for k in range(0, len(t), 3)]


def _fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def keyword_match():
    words = [_fold(k) for k in KEYWORDS]
    return [(r["doc_id"], k) for r in read("documents", "doc_id", "text") for t in [_fold(r["text"] or "")] for k in words if k in t]


def clean_text():
    return [(r["doc_id"], " ".join((r["text"] or "").split())) for r in read("documents", "doc_id", "text")]


def parse_int():
    return [(r["doc_id"], m.group().replace(",", "") if (m := re.search(r"-?[\d,]+", r["text"] or "")) else -1) for r in read("documents", "doc_id", "text")]


def dedup_first():
    seen = {}
    for r in read("documents", "doc_id", "text", "source"):
        seen.setdefault(r["text"] or "", r)
    return seen


def upsert_first_seen():
    state = {}
    for r in read("events"):
        old = state.get(r["user_id"])
        state[r["user_id"]] = {"first": old["first"] if old else r["event_id"], "last": r["event_id"], "kind": r["event_type"]}
    return state


def upsert_whole_row():
    state = {f"C{r['c_custkey']}": (r["c_acctbal"], r["c_mktsegment"]) for r in read("customer")}
    for r in read("orders"):
        if r["o_orderpriority"] == "1-URGENT":
            state[f"C{r['o_custkey']}"] = (r["o_totalprice"], r["o_orderstatus"])
    return state


def new_posts_capped():
    rows = read("orders")
    known, got = {r["o_custkey"] for r in rows if r["o_orderpriority"] == "1-URGENT"}, defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["o_orderdate"], r["o_orderkey"])):
        if r["o_custkey"] not in known and len(got[r["o_custkey"]]) < 2:
            got[r["o_custkey"]].append(r["o_orderkey"])
    return got


def min_count_filter():
    n = Counter(r["l_orderkey"] for r in read("lineitem", "l_orderkey"))
    return [(r["o_orderkey"], n[r["o_orderkey"]]) for r in read("orders") if n[r["o_orderkey"]] >= 4]


def recency_filter():
    return [r["event_id"] for r in read("events") if r["event_type"] in ("error", "signup") or r["ts"].timestamp() >= CUTOFF]


def json_first_match():
    return [(r["event_id"], json.loads(r["props"]).get("k")) for r in read("events", "event_id", "props")]


class _Facts(HTMLParser):
    def __init__(self):
        super().__init__()
        self.at, self.got, self.links = "", defaultdict(str), 0

    def handle_starttag(self, tag, attrs):
        self.at = tag
        self.links += tag == "a"

    def handle_data(self, data):
        if self.at in ("title", "h1"):
            self.got[self.at] += data


def parse_pages():
    out = []
    for r in read("pages", "page_id", "html"):
        p = _Facts()
        p.feed(r["html"] or "")
        out.append((r["page_id"], p.got["title"], p.got["h1"], p.links))
    return out


def label_compare():
    b = {r["doc_id"]: r for r in read("documents", "doc_id", "text", "n_chars")}
    return sum((r["quality"] == 1) == (b[r["doc_id"]]["n_chars"] > 1000) for r in read("labels") if r["doc_id"] in b)


def op5_exact_dedup():
    groups = defaultdict(list)
    for r in read("documents", "doc_id", "text"):
        groups[r["text"] or ""].append(r["doc_id"])
    return [(i, max(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids]


def _shingles(text: str) -> Counter:
    w = re.findall(r"\w+", text.lower())
    return Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1))))


def op1_near_dedup():
    """All pairs that share a rare shingle, compared exactly."""
    sets = [_shingles(r["text"] or "") for r in read("documents", "doc_id", "text")]
    by, parent = defaultdict(list), list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    done = set()
    for rows in by.values():
        for a, i in enumerate(rows if len(rows) < 50 else ()):
            for j in rows[:a]:
                if (j, i) not in done:
                    done.add((j, i))
                    low = sum((sets[i] & sets[j]).values())
                    if low >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - low):
                        parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def op7_decontaminate():
    """Windows of thirteen words, unchanged ones only."""
    grams = {tuple(w[k : k + 13]) for r in read("benchmark") for w in [re.findall(r"\w+", (r["text"] or "").lower())] for k in range(len(w) - 12)}
    return [r["doc_id"] for r in read("documents", "doc_id", "text") for w in [re.findall(r"\w+", (r["text"] or "").lower())] if any(tuple(w[k : k + 13]) in grams for k in range(len(w) - 12))]


def op9_warc():
    latest, out = {}, []
    pages = read("pages")
    for r in pages:
        latest[r["html"]] = max(latest.get(r["html"], -1), r["page_id"])
    for r in pages:
        bisect.insort(out, (r["url"], r["page_id"], hashlib.sha1((r["html"] or "").encode()).hexdigest(), latest[r["html"]]))
    return out


NAIVE = [
    context_enrich_branch, depth_stack_parent, chunk_by_thread, keyword_match, clean_text, parse_int, dedup_first, upsert_first_seen, upsert_whole_row, new_posts_capped, min_count_filter, recency_filter,
    json_first_match, parse_pages, label_compare, op5_exact_dedup, op1_near_dedup, op7_decontaminate, op9_warc,
]


def main() -> None:
    seconds = {}
    for fn in NAIVE:
        began = time.perf_counter()
        fn()
        seconds[fn.__name__] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "seconds in plain Python", "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
