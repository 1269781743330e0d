"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text, shingle=4):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(items, max_bits=4):
    """items: (id, fingerprint) to the smallest id reachable, in order."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(items):
        r = find(i)
        least[r] = min([x for x in (least.get(r), k) if x is not None], default=None)
    return [least[find(i)] for i in range(len(items))]


def exact_key(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", text or "").encode()).hexdigest()


def token_ids(texts, separator=0):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [separator] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def best_fit(lengths, capacity):
    """Number of sequences of best-fit decreasing, document by document."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def mix(rows, weights=(1, 2, 3), most=3, seed="mix"):
    """rows: (id, source, text) to {index: (size, target, taken)}."""
    size = [len(WORD.findall(t or "")) for _, _, t in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    own = {s: sum(z for z, r in zip(size, rows) if r[1] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(own.values()) - sum(most * own[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: float(most * own[s]) if s in full else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in full and target[s] > most * own[s]}
        if not over:
            break
        full |= over
    out = {}
    for s in names:
        budget, before = int(target[s] + 0.5), 0
        at = sorted((i for i, r in enumerate(rows) if r[1] == s), key=lambda i: (
            hashlib.md5(f"{seed}{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), rows[i][0] or 0, i))
        epochs, rest = divmod(budget, max(own[s], 1))
        for i in at:
            out[i] = (size[i], target[s], epochs * size[i] + max(0, min(size[i], rest - before)))
            before += size[i]
    return out
