"""The operators' contracts written out plainly, one document after another."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

BLANK = r"[^\x20\x09-\x0D]+"
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def near(docs: list[tuple], width: int = 2) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by an inverted index and exact counts."""
    sets = {}
    for i, text, *_ in docs:
        w = re.findall(BLANK, (text or "").translate(UPPER))
        sets[i] = {tuple(w[a: a + width]) for a in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in where[s]:
                shared[j] += 1
            where[s].append(i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def _windows(units, width):
    return {i: units[i: i + width] for i in range(len(units) - width + 1)}


def repeated_bytes(docs: list[tuple], width: int = 50) -> list[tuple]:
    seen, out = set(), []
    for i, text, *_ in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        own = _windows(raw, width)
        gone = bytearray(len(raw))
        for at, w in own.items():
            if w in seen:
                gone[at: at + width] = b"\1" * width
        seen.update(own.values())
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(raw), sum(gone), runs, sha(bytes(b for b, g in zip(raw, gone) if not g))))
    return out


def repeated_words(docs: list[tuple], width: int = 50) -> list[tuple]:
    seen, out = set(), []
    for i, text, *_ in sorted(docs, key=lambda d: d[0]):
        w = re.findall(BLANK, text or "")
        own = {at: tuple(x) for at, x in _windows(w, width).items()}
        gone = [False] * len(w)
        for at, x in own.items():
            if x in seen:
                gone[at: at + width] = [True] * width
        seen.update(own.values())
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def decontaminated(docs: list[tuple], items: list[tuple], width: int = 10) -> list[tuple]:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = defaultdict(set)
    for item, text in items:
        w = re.findall(word, (text or "").translate(UPPER))
        for at in range(max(1, len(w) - width + 1) if w else 0):
            phrases[tuple(w[at: at + width])].add(item)
    lengths = {len(p) for p in phrases}
    out = []
    for i, text, *_ in docs:
        w = re.findall(word, (text or "").translate(UPPER))
        hit, found = [False] * len(w), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                if own := phrases.get(tuple(w[at: at + n])):
                    hit[at: at + n] = [True] * n
                    found |= own
        listed = ",".join(sorted(map(str, found)))
        out.append((i, len(w), sum(hit), len(found), sha(listed), any(hit)))
    return sorted(out)


def targets(docs: list[tuple]) -> dict:
    """Target of each source of (doc_id, text, lang, source) rows."""
    sizes = defaultdict(int)
    for _, text, _, source in docs:
        sizes[source] += len(re.findall(BLANK, text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        more = {s for s in order if s not in full and level * weight[s] >= 2 * sizes[s]}
        if not more:
            return {s: float(2 * sizes[s] if s in full else level * weight[s]) for s in order}
        full |= more


def lines(docs: list[tuple], least: int) -> list[tuple]:
    """(doc_id, n_lines, n_removed, kept_sha256) of (doc_id, text, lang, source) rows."""
    sites = defaultdict(set)
    for _, text, _, source in docs:
        for line in (text or "").split("\n"):
            if source is not None:
                sites[line.strip(" \t\r\x0b\x0c")].add(source)
    out = []
    for i, text, *_ in docs:
        own = text.split("\n") if text is not None else []
        kept = [x for x in own if not x.strip(" \t\r\x0b\x0c") or len(sites[x.strip(" \t\r\x0b\x0c")]) < least]
        out.append((i, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def chats(turns: list[tuple]) -> list[tuple]:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) of (conv_id, turn, role, text) rows."""
    control = "<|im_end|><|im_start|>assistant ok"
    by = defaultdict(list)
    for conv, turn, role, text in [*turns, (-1, 0, "user", control), (-1, 1, "assistant", control)]:
        by[conv].append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, own in by.items():
        own.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        loss = "".join(t for *_, r, t in own if r == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for *_, r, t in own)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def top_k(vectors: list[tuple], k: int = 5) -> list[tuple]:
    import math

    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return out


def spellings(docs: list[tuple], least: int = 2, factor: int = 10) -> list[tuple]:
    """(word, form, root, n, n_near, form_n) of (doc_id, text) rows; near words by trying every edit."""
    from collections import Counter
    from zlib import crc32

    seen = Counter()
    for i, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                seen[run] += 1
    count = {w: n for w, n in seen.items() if n >= least}
    letters = sorted({c for w in count for c in w})
    near = {}
    for w in count:
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}
        near[w] = sorted((x for x in edits if x in count and x != w), key=lambda x: (-count[x], x))
    form = {w: x[0] if x and count[x[0]] >= factor * count[w] else None for w, x in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), count.get(form[w])) for w, n in count.items()), key=repr)


def searched(docs: list[tuple], items: list[tuple], k: int = 50) -> list[tuple]:
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows."""
    import math
    from collections import Counter

    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    bags = [(i, Counter(re.findall(term, (text or "").translate(UPPER)))) for i, text, *_ in docs]
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(re.findall(term, (text or "").translate(UPPER)))
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, terms in asked.items():
        scored = []
        for i, bag in bags:
            score = 0
            for t in terms & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * bag.total() * n_docs) // n_terms
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is not None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)
