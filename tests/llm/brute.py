"""Plain per-document versions of the contracts, written directly from their wording."""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter

sys.set_int_max_str_digits(0)
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def join_spans(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted((s, kinds.index(k), k, e) for k, s, e in spans))


def luhn(d):
    odd = sum(int(c) for c in d[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])) % 10 == 0


PII = ("email", "ip", "card", "phone")


def pii(text):
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    c = Counter(s[0] for s in spans)
    return (*(c[k] for k in PII), sha(join_spans(spans, PII)))


SECRETS = ("assign", "access", "hex")


def secrets(text):
    text = text or ""
    rx = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|" \
         r"[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    spans = [("assign", *m.span()) for m in re.finditer(rx, text) if len(m.group(2)) >= 6]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    c = Counter(s[0] for s in spans)
    return (*(c[k] for k in SECRETS), sha(join_spans(spans, SECRETS)))


def rules(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    wins = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if wins[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), failed)


CONTAM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def contam_windows(items):
    out = {}
    for i, t in items:
        w = CONTAM_WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 12)) if w else ():
            out.setdefault(tuple(w[k:k + 13]), set()).add(str(i))
    return out


def contam(text, windows):
    w = CONTAM_WORD.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for size in {len(k) for k in windows}:
        for i in range(len(w) - size + 1):
            got = windows.get(tuple(w[i:i + size]))
            if got:
                hit.update(range(i, i + size))
                items |= got
    return len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)


def shingles(text):
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))


def components(docs):
    """doc_id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    for i, (d, s) in enumerate(sets):
        shared = Counter(j for x in s for j in index[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[j][1]) - n):
                a, b = find(d), find(sets[j][0])
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def chat(convs):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) from (conv_id, turn, role, text) rows."""
    by = {}
    for c, t, r, x in convs:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, rows in by.items():
        rows.sort()
        loss = "".join(x for _, _, r, x in rows if r == "assistant")
        out[c] = (len(rows), sha("".join(f"{r}\n{x}\n" for _, _, r, x in rows)), len(loss), sha(loss))
    return out


def bad_hosts(hosts):
    """Hosts whose failure rate, as a beta posterior, lies above one half but for one case in a hundred."""
    rates = [sum(x) / len(x) for x in hosts.values()]
    mean, chance = sum(rates) / len(rates), sum(1 / len(x) for x in hosts.values()) / len(rates)
    if len(rates) < 2 or chance == 1:
        strength = 2.0
    else:
        var = sum((r - mean) ** 2 for r in rates) / (len(rates) - 1)
        over = var - chance * mean * (1 - mean)  # without what chance alone gives
        share = over / ((1 - chance) * mean * (1 - mean)) if over > 0 else 0.0
        strength = min(1e4, max(2.0, 1 / share - 1)) if share else 1e4
    bad = set()
    for host, x in hosts.items():
        a, b = sum(x) + mean * strength, len(x) - sum(x) + (1 - mean) * strength
        if a / (a + b) - 2.326 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5 > 0.5:
            bad.add(host)
    return bad
