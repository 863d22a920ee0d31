"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def targets(sizes: dict) -> dict:
    """Reshares the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        share = {s: 3 * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and share[s] > 3 * sizes[s]}
        if not over:
            return share
        full |= over


def edited(docs: list[tuple[int, str | None]]) -> dict[int, str]:
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        out[doc_id] = text[: len(text) - n] + following[:n]
    return out


def winnow(text: str, gram: int, window: int, unit_chars: int, of) -> list:
    """(gram, position) of the chosen grams; `of` gives the number of a gram."""
    units = re.findall(rf"[^\x20\x09-\x0D]{{1,{unit_chars}}}", text)
    n = len(units) - gram + 1
    grams = [tuple(units[i : i + gram]) for i in range(n)] if n > 0 else [tuple(units)] if units else []
    numbers = [of(g) for g in grams]
    out = []
    for at in range(max(len(grams) - window + 1, 1) if grams else 0):
        here = range(at, min(at + window, len(grams)))
        best = min(here, key=lambda i: (numbers[i], -i))
        if not out or out[-1][1] != best:
            out.append((numbers[best], best))
    return out


def base_scores(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    lists = {i: [*WORD.findall((t or "").translate(UPPER)), "\n"] for i, t in docs}
    counts = Counter(w for i, ws in lists.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in lists.items()
    }


def without_repeats(docs: list[tuple[int, str | None]], width: int = 35) -> dict[int, tuple]:
    lists = [(i, WORD.findall(t or "")) for i, t in docs]
    seen = Counter(tuple(ws[p : p + width]) for _, ws in lists for p in range(len(ws) - width + 1))
    out = {}
    for i, ws in lists:
        gone = [False] * len(ws)
        for p in range(len(ws) - width + 1):
            if seen[tuple(ws[p : p + width])] > 1:
                gone[p : p + width] = [True] * width
        kept = [w for w, g in zip(ws, gone, strict=True) if not g]
        out[i] = (len(ws), sum(gone), sha(" ".join(kept)))
    return out


def contamination(docs, benchmark, width: int = 13) -> dict[int, tuple]:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(UPPER))
    windows = defaultdict(set)
    for item, text in benchmark:
        ws = split(text)
        for p in range(max(1, len(ws) - width + 1) if ws else 0):
            windows[tuple(ws[p : p + width])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        ws = split(text)
        hit, items = [False] * len(ws), set()
        for n in lengths:
            for p in range(len(ws) - n + 1):
                if (found := windows.get(tuple(ws[p : p + n]))) is not None:
                    hit[p : p + n] = [True] * n
                    items |= found
        n_hit = sum(hit)
        out[i] = (len(ws), n_hit, len(items), sha(",".join(sorted(items))), n_hit > 0 and 20 * n_hit >= len(ws))
    return out


def _luhn(digits: str) -> bool:
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")),
        ),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m)]


def simhash(text: str | None) -> int:
    ws = WORD.findall((text or "").translate(UPPER))
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: list[tuple[int, int]], distance: int = 2) -> dict[int, int]:
    distinct = np.array(sorted({f for _, f in prints}), np.uint64)
    root = np.arange(len(distinct))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, value in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ value) <= distance):
            a, b = find(i), find(i + 1 + j)
            root[max(a, b)] = min(a, b)
    place = {int(f): i for i, f in enumerate(distinct)}
    least: dict[int, int] = {}
    for doc_id, f in prints:
        r = find(place[f])
        least[r] = min(doc_id, least.get(r, doc_id))
    return {doc_id: least[find(place[f])] for doc_id, f in prints}


def merkle(docs: list[tuple]) -> dict:
    """Of rows (doc_id, source, lang, n_chars, text) with ids of their own: doc_id -> the proof's columns."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda row: sha("".join(map(field, row)))

    def tree(nodes: list[str]) -> list[list[str]]:
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
        return levels

    def path(levels: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
        steps = []
        for level in levels[:-1]:
            run = at - at % 2
            steps.append((level[run:at], level[at + 1 : run + 2]))
            at //= 2
        return steps

    langs = sorted({r[2] for r in docs}, key=lambda v: (v is not None, (v or "").encode()))
    rows = {lang: sorted(r for r in docs if r[2] == lang) for lang in langs}
    trees = {lang: tree([leaf(r) for r in rows[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0], {}
    for g, lang in enumerate(langs):
        for i, row in enumerate(rows[lang]):
            steps = path(trees[lang], i) + path(top, g)
            changed = zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            folded = leaf((*row[:3], row[3] + 1, row[4]) if changed else row)
            for left, right in steps:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(d for left, right in steps for d in (*left, *right)))
            out[row[0]] = (leaf(row), trees[lang][-1][0], root, proof, folded, folded == root)
    return out


ROLE_NAMES = {"u": "user", "a": "assistant"}


def damaged_turns(rows: list[tuple]) -> dict:
    """conv_id -> its rows (turn, role, text) after damage, in order."""
    blank = lambda v: " " if v is None else v
    out: dict = {}
    for conv, turn, role, text in rows:
        role, text, own = blank(role), blank(text), out.setdefault(conv, [])
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
    return {conv: sorted(own, key=order) for conv, own in out.items()}


def turn_faults(turns: list[tuple]) -> list[str]:
    seen, out = set(), []
    for _, role, text in turns:
        visible = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        out.append(fault)
        seen.add((role, text))
    return out


def all_repairs(turns: list[tuple], most: int = 2):
    """(cost, audit, repaired) of all edits with at most so many turns inserted in one place."""
    marks = turn_faults(turns)

    def go(at: int, roles: str, cost: int, audit: str, done: list, room: int):
        if not re.fullmatch("(s?(ua)*u?)", roles):
            return
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            yield cost, audit, done
        if room:
            for r, name in ROLE_NAMES.items():
                yield from go(at, roles + r, cost + 2, audit + "I", [*done, f"{name}:"], room - 1)
        if at < len(turns):
            _, role, text = turns[at]
            yield from go(at + 1, roles, cost + 3, audit + "D", done, most)
            if marks[at] not in ("blank", "duplicate"):
                more = marks[at] == "truncated"
                yield from go(at + 1, roles + (role[:1] or "-"), cost + more, audit + "K", [*done, f"{role}:{text}"], most)
                for r, name in ROLE_NAMES.items():
                    yield from go(at + 1, roles + r, cost + 2 + more, audit + "R", [*done, f"{name}:{text}"], most)

    return go(0, "", 0, "", [], most)


def cheapest_repair(turns: list[tuple]) -> tuple[int, str, list[str]]:
    """Cheapest paths turn by turn, with every path of least (cost, audit) for each role that may come next."""
    marks = turn_faults(turns)
    # What the roles so far are: "" none, s, u (assistant is due), a (complete).
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def better(into: dict, state, path) -> bool:
        if state is not None and (state not in into or path[:2] < into[state][:2]):
            into[state] = path
            return True
        return False

    def insert(states: dict) -> dict:
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, done) in list(states.items()):
                for r, name in ROLE_NAMES.items():
                    changed |= better(states, after.get((state, r)), (cost + 2, audit + "I", [*done, f"{name}:"]))
        return states

    for (_, role, text), mark in zip(turns, marks, strict=True):
        new: dict = {}
        more = mark == "truncated"
        for state, (cost, audit, done) in insert(best).items():
            better(new, state, (cost + 3, audit + "D", done))
            if mark not in ("blank", "duplicate"):
                better(new, after.get((state, role[:1])), (cost + more, audit + "K", [*done, f"{role}:{text}"]))
                for r, name in ROLE_NAMES.items():
                    better(new, after.get((state, r)), (cost + 2 + more, audit + "R", [*done, f"{name}:{text}"]))
        best = new
    best = insert(best)
    return min(best[s] for s in ("", "a") if s in best)


def repaired_conversations(rows: list[tuple]) -> dict:
    out = {}
    for conv, turns in damaged_turns(rows).items():
        marks, known = turn_faults(turns), [t[0] for t in turns if t[0] is not None]
        initials = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, done = cheapest_repair(turns)
        counts = [marks.count(m) for m in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(done)))
    return out


def personal_spans(docs: list[tuple], generalise: float, remove: float, least: int) -> list[list[tuple]]:
    """Per row of (id, text): base spans, then those of terms to generalise, then to remove; counts by dictionaries."""
    import regex

    digits = lambda v: re.sub("[^0-9]", "", v)
    name = lambda t, k, a, b: f"{k}:{digits(t[a:b]) if k in ('card', 'phone') else t[a:b].translate(UPPER)}"
    texts = [t or "" for _, t in docs]
    number = Counter(texts)
    entities = {t: {name(t, *s) for s in base_spans(t)} for t in number}
    words = {t: set(regex.findall(r"\p{L}{3,}", t.lower())) for t in number}
    n_entity, n_term, n_both, together = Counter(), Counter(), Counter(), Counter()
    for t, n in number.items():
        for w in words[t]:
            n_term[w] += n
        for e in entities[t]:
            n_entity[e] += n
            for w in words[t]:
                n_both[e, w] += n
                together[e, w] += 1
    action = {}
    for (e, w), both in n_both.items():
        information = np.log2(len(docs) / n_entity[e])
        if together[e, w] >= least and information > 0:
            share = np.log2(len(docs) * both / (n_entity[e] * n_term[w])) / information
            if share >= generalise:
                action[e, w] = "drop" if share >= remove else "term"
    out = []
    for t in texts:
        base = base_spans(t)
        chosen: dict = {}
        for e in entities[t]:
            for w in words[t]:
                if (e, w) in action:
                    chosen[w] = min(action[e, w], chosen.get(w, "term"))
        found = [(chosen.get(m[0].lower()), m.start(), m.end()) for m in regex.finditer(r"\p{L}{3,}", t)]
        found = [m for m in found if m[0] and not any(m[1] < b and a < m[2] for _, a, b in base)]
        out.append(base + [m for m in found if m[0] == "term"] + [m for m in found if m[0] == "drop"])
    return out
