"""A small set of tables with every case the operators must define, and plain versions of them."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pyarrow as pa
import pyarrow.parquet as pq
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}{'é' if draw.random() < 0.1 else ''}" for _ in range(n))


ITEMS = [
    (0, prose(900, 40)),
    (1, prose(901, 13)),
    (2, "Only seven words stand in here"),
    (2, prose(902, 20)),
    (3, None),
    (4, " .,; "),
    (10, prose(900, 40)),
    (None, prose(903, 15)),
]


def documents():
    """(doc_id, text, lang, source) rows."""
    base, other = prose(1, 120), prose(2, 60)
    rows = [
        (1, base, "en", "b"),
        (2, base, "en", "a"),
        (3, base.replace(" ", "\n", 5), "en", "a"),
        (4, base + "  ", "fr", None),
        (5, None, None, None),
        (6, "", "en", "a"),
        (7, " \t\x0b\x0c\r\n", "en", "a"),
        (8, "word", "de", "c"),
        (9, "two words", "de", "c"),
        (None, other, "es", "c"),
        (10, other, "es", "c"),
        (10, other, "es", "c"),
        (11, other + " tail", "es", "c"),
        (11, prose(3, 30), "es", "c"),
        (12, prose(4, 20) + " " + base[:400] + " " + prose(5, 20), "en", "b"),
        (13, "a " * 60, "en", "b"),
        (14, "a " * 61 + "b", "en", "b"),
        (15, "x" * 350, "en", "b"),
        (16, prose(6, 30000, 5000), "en", "long"),
        (17, prose(6, 30000, 5000)[500:60000], "en", "long"),
        (18, "é" * 120 + " " + "ß" * 80, "de", "c"),
        (19, prose(900, 40) + " " + prose(7, 10), "en", "a"),
        (20, prose(8, 2000) + " " + prose(901, 13).upper(), "en", "a"),
        (21, "ONLY seven, words stand in here!", "en", "a"),
        (22, prose(903, 15), "en", "zz"),
        (23, "\x00nul and\x00more " * 12, "en", "zz"),
        (24, "1 2 3 !!", "en", "zz"),
    ]
    rows += [(100 + i, base if i % 3 else base + f" n{i}", "en", "hot") for i in range(40)]
    rows += [(200 + i, prose(50 + i, 25 + i), "fr" if i % 2 else "en", "a") for i in range(12)]
    return rows


EXTRA = [
    "size", "shard", "slot", "n_words", "n_removed", "kept", "score", "fingerprint", "digest", "pattern",
    "hit_spans", "contaminated", "lang_pred", "trusted", "n_bytes", "group_size", "component", "copies",
    "document", "words", "label", "quality",
]


def write_tables(folder, rows, items=ITEMS, labels=None, pages=()):
    ids, texts, langs, sources = zip(*rows) if rows else ((), (), (), ())
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "text": pa.array(texts, pa.string()),
        "lang": pa.array(langs, pa.string()),
        "source": pa.array(sources, pa.string()),
        "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
        **{c: pa.array([f"own {c}"] * len(rows), pa.string()) for c in EXTRA},
    }
    pq.write_table(pa.table(columns), f"{folder}/documents.parquet")
    columns = {
        "item_id": pa.array([i for i, _ in items], pa.int64()),
        "text": pa.array([t for _, t in items], pa.string()),
    }
    pq.write_table(pa.table(columns), f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i in ids if i] if labels is None else labels
    columns = {
        c: pa.array([x[k] for x in labels], pa.int64() if c == "doc_id" else pa.int32())
        for k, c in enumerate(("doc_id", "quality", "toxic"))
    }
    pq.write_table(pa.table(columns), f"{folder}/labels.parquet")
    columns = {
        "page_id": pa.array([p[0] for p in pages], pa.int64()),
        "url": pa.array([p[1] for p in pages], pa.string()),
        "html": pa.array([p[2] for p in pages], pa.string()),
    }
    pq.write_table(pa.table(columns), f"{folder}/pages.parquet")
    return str(folder)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def crc(id):
    return zlib.crc32(str(id).encode())


def counted(rows):
    """Rows as a sorted list that can be compared whatever their order."""
    return sorted((tuple(r) for r in rows), key=repr)


def shards(rows, n=24):
    sized = []
    for i, t, *_ in rows:
        raw = (t or "").encode()
        sized.append((i is not None, i or 0, len(raw) + 8, zlib.crc32(raw), i))
    sized.sort(key=lambda r: r[:4])
    total, before, slots, out = sum(r[2] for r in sized), 0, defaultdict(int), []
    for *_, size, code, i in sized:
        s = (2 * before + size) * n // (2 * total)
        out.append((i, size, code, "bytes", s, slots[s], None))
        slots[s] += 1
        before += size
    return out


def exact_groups(rows):
    """(doc_id, keep_id, group_size, text_sha256) and how many rows of each text stay."""
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for text, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), sha(text)) for m in members]
    return out


def without_windows(rows, width=13):
    order = {i: (i is None, i or 0) for i, *_ in rows}
    first = {}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - width + 1):
            gram = tuple(w[k : k + width])
            first[gram] = min(first.get(gram, order[i]), order[i])
    out = []
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        hit = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < order[i]:
                hit[k : k + width] = [True] * width
        kept = [x for x, h in zip(w, hit) if not h]
        out.append((i, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def without_strings(rows, width=100):
    first = {}

    def rank(i, t):
        raw = (t or "").encode()
        key = xxhash.xxh64_intdigest(raw, 42)
        return (i is None, i or 0, key - (1 << 64) if key >= 1 << 63 else key)

    for i, t, *_ in rows:
        raw, order = (t or "").encode(), rank(i, t)
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            first[s] = min(first.get(s, (*order, k)), (*order, k))
    out = []
    for i, t, *_ in rows:
        raw, order = (t or "").encode(), rank(i, t)
        hit = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < (*order, k):
                hit[k : k + width] = b"\1" * width
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = len(re.findall(b"\1+", bytes(hit)))
        out.append((i, len(raw), len(raw) - len(kept), spans, sha(kept)))
    return out


def fingerprint(text, n=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    grams = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]
    grams = grams or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(prints, most=2):
    """For every distinct fingerprint, the fingerprints it is linked with over any way."""
    prints = sorted(set(prints))
    up = {p: p for p in prints}

    def root(p):
        while up[p] != p:
            up[p] = up[up[p]]
            p = up[p]
        return p

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= most:
                up[root(a)] = root(b)
    return {p: root(p) for p in prints}


def simhash_rows(rows):
    prints = [fingerprint(t) for _, t, *_ in rows]
    root = component_ids(prints)
    lowest = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            lowest[root[p]] = min(lowest.get(root[p], i), i)
    return [(i, f"{p:016x}", lowest.get(root[p])) for (i, *_), p in zip(rows, prints)]


def bench_words(text):
    return BENCH_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hit_rows(rows, items, width=13):
    windows = defaultdict(set)
    for name, text in items:
        w = bench_words(text)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("" if name is None else str(name))
    sizes = {len(g) for g in windows}
    out = []
    for i, t, *_ in rows:
        w, found = bench_words(t), set()
        hit = [False] * len(w)
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[k : k + n]))) is not None:
                    found |= names
                    hit[k : k + n] = [True] * n
        n_hit = sum(hit)
        bad = n_hit > 0 and 20 * n_hit >= len(w)
        out.append((i, len(w), n_hit, len(found), sha(",".join(sorted(found))), bad))
    return out


def mixed_rows(rows):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return sizes, target
        full |= over


def shingle_sets(rows, n=4):
    out = []
    for _, t, *_ in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        out.append(frozenset(grams or ([tuple(words)] if words else [])))
    return out


def alike_rows(rows):
    """(doc_id, n_shingles, component_id) by comparing all texts."""
    sets = shingle_sets(rows)
    kinds = sorted(set(sets), key=lambda s: sorted(s))
    up = {s: s for s in kinds}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    for k, a in enumerate(kinds):
        for b in kinds[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[root(a)] = root(b)
    lowest = {}
    for (i, *_), s in zip(rows, sets):
        if i is not None:
            lowest[root(s)] = min(lowest.get(root(s), i), i)
    return [(i, len(s), lowest.get(root(s)) if s else i) for (i, *_), s in zip(rows, sets)]


def phrase_rows(rows, least=10, most=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    f, n = defaultdict(int), defaultdict(int)
    for _, t, lang, _ in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    often = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    held = defaultdict(int)
    for (lang, p), a in often.items():
        if len(p) == 3:
            for part in (p[:2], p[1:]):
                held[lang, part] = max(held[lang, part], a)
    out = []
    for lang in n:
        own = []
        for (where, p), a in often.items():
            if where != lang or 100 * held[lang, p] >= 50 * a:
                continue
            cuts = [(f[lang, p[:k]], f[lang, p[k:]], k) for k in range(1, len(p))]
            score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            own.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def plain_runs(words):
    """(start, length, period) of every run, looking at each period by itself."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : j + q]
            if j > i and length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1 if j == i else j
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_rows(rows):
    out = []
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        h, n = (1 if i is None else crc(i)), len(w)
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        found = plain_runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        gone = {k for a, length, q in found for k in range(a + q, a + length)}
        lines = "".join(f"{a},{length},{q}\n" for a, length, q in found)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(kept)))
    return out
