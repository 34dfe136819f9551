"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def lettered(text):
    return LETTERED.findall((text or "").translate(LOWER))


def leaks(docs, items):
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of (id, text) and (item id, text)."""
    windows = defaultdict(set)
    for i, text in items:
        words = lettered(text)
        n = min(10, len(words))
        for p in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[p : p + n])].add(i)
    out = []
    for i, text in docs:
        words, hit, found = lettered(text), set(), set()
        for n in {len(w) for w in windows}:
            for p in range(len(words) - n + 1):
                got = windows.get(tuple(words[p : p + n]))
                if got:
                    hit.update(range(p, p + n))
                    found |= {str(x) for x in got if x is not None}
        out.append((i, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, k):
    words = spaced(text)
    return {tuple(words[p : p + k]) for p in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def groups(docs, k, percent=80):
    """Index of each row's group; wordless rows are groups of their own."""
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    return [find(x) for x in range(len(docs))], [len(s) for s in sets]


def repeats(docs, length):
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept bytes)."""
    raw = [(t or "").encode() for _, t in docs]
    counts = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(docs, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len([1 for p, g in enumerate(gone) if g and not (p and gone[p - 1])])
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def quality(docs, max_share=0.05, min_docs=10, min_left=0.3):
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, kept) of (id, text, host), and the texts left."""
    norm = lambda line: " ".join(spaced(line))
    holds, texts = defaultdict(set), defaultdict(set)
    for _, t, h in docs:
        texts[h or ""].add(t or "")
        for line in (t or "").split("\n"):
            if norm(line):
                holds[h or "", norm(line)].add(t or "")
    out = []
    for i, t, h in docs:
        t = t or ""
        words = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        wins = [tuple(words[p : p + 8]) for p in range(len(words) - 7)]
        count = Counter(wins)
        covered = {p + j for p, w in enumerate(wins) if count[w] > 1 for j in range(8)}
        above = lambda x: len(holds[h or "", norm(x)]) > max(min_docs, max_share * len(texts[h or ""]))
        gone = sum(len(norm(x).split(" ")) for x in lines if above(x))
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        kept = not failed and len(words) - gone >= min_left * len(words)
        left = "\n".join(x for x in t.split("\n") if not (norm(x) and above(x)))
        out.append(((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, gone, kept), left))
    return out


def alignment(docs):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of (id, text)."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    bytes_b = lambda p: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
    rows, count = [], Counter()
    for i, text in docs:
        found, links = [], []
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ends_a, ends_b = {}, {}
        joined = [b"", b""]
        for k, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
            for n, t in enumerate(ids):
                joined[k] += bytes(byte_of[c] for c in a.id_to_token(t)) if k == 0 else bytes_b(b.id_to_piece(t))
                ends[len(joined[k])] = n
        if text and joined == [(" " + text).encode()] * 2:
            at_a = at_b = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                links.append((ids_a[ends_a[end]], ids_b[ends_b[end]]))
                found.append(",".join(map(str, ids_a[at_a : ends_a[end] + 1])) + "|" + ",".join(map(str, ids_b[at_b : ends_b[end] + 1])))
                at_a, at_b = ends_a[end] + 1, ends_b[end] + 1
        else:
            ids_a = ids_b = []
        count.update(links)
        rows.append((i, ids_a, ids_b, found, links))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(i, len(x), len(y), len(g), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, x, y, g, ls in rows]
