"""Plain, slow versions of the operators, for comparison on small tables."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def tie(text) -> int:
    number = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return number - (1 << 64) * (number >> 63)


def suffix_dedup(rows, length=100):
    """{(id, text): flags of removed bytes} of distinct documents."""
    order = lambda r: (r[0] is None, r[0] or 0, tie(r[1]))
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=order):
        data = (text or "").encode()
        flags = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                flags[p:p + length] = b"\1" * length
            else:
                seen.add(window)
        out[doc, text] = bytes(flags)
    return out


def spans(flags):
    return [m.span() for m in re.finditer(b"\1+", flags)]


def fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, radius=4):
    """Smallest id of each row's component, by comparing all pairs of rows."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, doc in enumerate(ids):
        root = find(i)
        known = least.get(root)
        least[root] = doc if known is None else known if doc is None else min(known, doc)
    return [least[find(i)] for i in range(len(ids))]


def lm(rows, rounds=500, buckets=24):
    """Scores of (id, text) rows: [(held_out, n_tokens, n_known, train_tokens, base, score)]."""
    token = [(text or "").encode().lower().split() + [None] for _, text in rows]
    fold = [zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 for doc, _ in rows]

    def counted(wanted):
        word, pair, before = Counter(), Counter(), Counter()
        for ws, f in zip(token, fold):
            if wanted(f):
                word.update(ws)
                befores = ["^", *ws[:-1]]
                before.update(befores)
                pair.update(zip(befores, ws))
        return word, pair, before
    word, pair, before = counted(lambda f: f != 0)
    r_word, r_pair, r_before = counted(lambda f: f > 1)
    n, types, retained = sum(word.values()), len(word), max(sum(r_word.values()), 1)
    bucket = lambda k: min(k.bit_length(), buckets)
    share = lambda a, b: a / b if b else 0.0
    events = [(bucket(r_before[v]), share(r_pair[v, w], r_before[v]), r_word[w] / retained, 1 / (types + 1))
              for ws, f in zip(token, fold) if f == 1 for v, w in zip(["^", *ws[:-1]], ws)]
    weights = [(1 / 3,) * 3] * (buckets + 1)
    for _ in range(rounds):
        sums = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
        for b, *f in events:
            parts = [x * y for x, y in zip(weights[b], f)]
            for k in range(3):
                sums[b][k] += parts[k] / sum(parts)
            sums[b][3] += 1
        new = []
        for b in range(buckets + 1):
            own = sums[b] if b in sums else None
            new.append(tuple((x + 1) / (own[3] + 3) for x in own[:3]) if own else new[-1] if new else weights[b])
        moved = max(abs(x - y) for a, b in zip(weights, new) for x, y in zip(a, b))
        weights = new
        if moved < 1e-3:
            break
    weights[0] = (0.0, *(x / sum(weights[0][1:]) for x in weights[0][1:]))
    out = []
    for ws, f in zip(token, fold):
        base = sum(math.log10((word[w] + 0.1) / (n + 0.1 * (types + 1))) for w in ws)
        score = 0.0
        for v, w in zip(["^", *ws[:-1]], ws):
            a, b, c = weights[bucket(before[v])]
            score += math.log10(a * share(pair[v, w], before[v]) + b * word[w] / max(n, 1) + c / (types + 1))
        out.append((f == 0, len(ws), sum(word[w] > 0 for w in ws), n, base, score))
    return out


def kneser_ney(training, texts, classes, order=4, size=64):
    """log10 probability of each sequence of classes under an interpolated modified Kneser-Ney model."""
    def grams(kinds):
        padded = [0] * (order - 1) + kinds
        return [tuple(padded[i:i + order]) for i in range(len(kinds))]
    tables = [Counter(g for t in training for g in grams(classes(t)))]
    for _ in range(order - 1):
        tables.insert(0, Counter(g[1:] for g in tables[0]))
    parts = []
    for table in tables:
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        off = [min(max(k - (k + 1) * y * a / b, 0.05), k - 0.05) if b else 0.5 * k
               for a, b, k in ((n2, n1, 1), (n3, n2, 2), (n4, n3, 3))]
        total, left = Counter(), defaultdict(float)
        for g, n in table.items():
            total[g[:-1]] += n
            left[g[:-1]] += off[min(n, 3) - 1]
        parts.append((table, off, total, left))

    def p(g):
        found = 1 / size
        for k, (table, off, total, left) in enumerate(parts, 1):
            tail = g[order - k:]
            if h := total[tail[:-1]]:
                n = table[tail]
                found = (n - off[min(n, 3) - 1] if n else 0) / h + left[tail[:-1]] / h * found
        return found
    return [sum(math.log10(p(g)) for g in grams(classes(t))) for t in texts]


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text, items, window=13):
    """(words, hit flags, item ids) of one text; items are (id, text)."""
    words = WORD.findall((text or "").encode().lower())
    flags, found = [False] * len(words), set()
    for name, said in items:
        item = WORD.findall((said or "").encode().lower())
        size = min(window, len(item))
        if not size:
            continue
        wanted = {tuple(item[i:i + size]) for i in range(len(item) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in wanted:
                flags[i:i + size] = [True] * size
                found.add(name)
    return words, flags, sorted(str(f) for f in found if f is not None)


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), len(lines))


def damaged(rows):
    """(conv, turn, role, text) rows after the faults, and all conversation ids."""
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (conv, turn, "user" if fate == 4 else role, text)
        out += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out, {r[0] for r in rows}


def repaired(kept):
    """The cheapest edits of some (role, text, fault) rows, by trying audits in order of cost."""
    heap, done = [(0, "", "", 0, ())], set()
    while heap:
        cost, audit, initials, at, lines = heapq.heappop(heap)
        if at == len(kept) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, lines
        # What is left hangs on the rows read and the place in the pattern; the first one there is best.
        state = (at, "^s" if initials == "s" else initials[-1:])
        if state in done or not re.fullmatch("s?(ua)*u?", initials):
            continue
        done.add(state)
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", initials + role[0], at, (*lines, role + ":")))
        if at == len(kept):
            continue
        role, text, fault = kept[at]
        heapq.heappush(heap, (cost + 4, audit + "D", initials, at + 1, lines))
        if fault not in ("blank", "duplicate"):
            extra = 3 * (fault == "truncated")
            if role:
                heapq.heappush(heap, (cost + extra, audit + "K", initials + role[0], at + 1, (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", initials + new[0], at + 1, (*lines, f"{new}:{text}")))


def conversation(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of (turn, role, text) rows in their order."""
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen
                      else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = repaired([(r, t, f) for (_, r, t), f in zip(rows, faults)])
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (
        "blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))


def sharding(rows, shards, parts=64):
    """(shard, slot) of each (id, text) row: large texts on the emptiest shard, the others by their middles."""
    last = (1 << 63) - 1
    said = [(text or "").encode() for _, text in rows]
    key = [(k - (1 << 64) * (k >> 63), last if doc is None else doc, n) for n, (k, (doc, _)) in enumerate(zip(
        (xxhash.xxh64_intdigest(t, 42) for t in said), rows))]
    size = [len(t) + 1 for t in said]
    of_text = Counter()
    for k, s in zip(key, size):
        of_text[k[0]] += s
    total = sum(size)
    held, own = [0] * shards, {}
    for s, k in sorted(((s, k) for k, s in of_text.items()), reverse=True):
        if s * parts * shards >= total >= s * shards:
            own[k] = min(range(shards), key=lambda i: (held[i], i))
            held[own[k]] += s
    low, high = 0.0, 2.0 * total
    for _ in range(200):  # the level by halving
        level = (low + high) / 2
        low, high = (level, high) if sum(max(0, level - h) for h in held) < total - sum(held) else (low, level)
    ends, shard, at, first = [], {}, 0, {}
    for h in held:
        ends.append((ends[-1] if ends else 0) + max(0, high - h))
    for n in sorted(range(len(rows)), key=key.__getitem__):
        k = key[n][0]
        first.setdefault(k, at)
        whole = of_text[k] * shards <= total
        middle = first[k] + of_text[k] // 2 if whole else at + size[n] // 2
        shard[n] = own.get(k, sum(int(e + 1e-6) <= middle for e in ends[:-1]))
        at += 0 if k in own else size[n]
    slots, out = Counter(), {}
    for n in sorted(range(len(rows)), key=key.__getitem__):
        out[n] = (shard[n], slots[shard[n]])
        slots[shard[n]] += 1
    return [out[n] for n in range(len(rows))]
