"""Plain Python versions of what the opN queries return, one text at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def blank_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text) -> tuple:
    text = text or ""
    words = blank_words(text)
    lines = [x for x in text.split("\n") if blank_words(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def base_secrets(text) -> tuple:
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    n = [sum(x[1] == k for x in out) for k in range(3)]
    return (*n, sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))))


def plain_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """One (n_words, n_hit, n_items, digest, contaminated) for each (id, text)."""
    where = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        k = min(10, len(words))
        for j in range(len(words) - k + 1 if k else 0):
            where[tuple(words[j : j + k])].add(item)
    sizes = {len(g) for g in where}
    out = []
    for _, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for k in sizes:
            for j in range(len(words) - k + 1):
                if (gram := tuple(words[j : j + k])) in where:
                    found |= where[gram]
                    hit.update(range(j, j + k))
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(words), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def shingles(text) -> frozenset:
    words = blank_words(lower(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def groups(docs: list[tuple]) -> dict:
    """id -> (set size, least id of its component)."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    both = Counter()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[:i]:
                both[(a, b)] += 1
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), top(d)) for d, s in sets.items()}


def pages(rows: list[tuple]) -> dict:
    """page -> (bytes, digest, type, refers_to)."""
    largest: dict[bytes, int] = {}
    for page, html in rows:
        body = (html or "").encode()
        largest[body] = max(largest.get(body, page), page)
    out = {}
    for page, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and largest[body] != page
        out[page] = (
            len(body),
            hashlib.sha1(body).hexdigest(),
            "revisit" if again else "response",
            largest[body] if again else None,
        )
    return out


def conversation(turns: list[tuple]) -> tuple:
    """(n_turns, digest, loss chars, loss digest) of (role, text) in order."""
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(said), len(learned), sha(learned)


def tokenizer():
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens(text, model) -> tuple:
    ids = model.encode_ordinary(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(text or "")
