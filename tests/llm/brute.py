"""Plain Python versions of the operators, without Spark and with other means."""

from __future__ import annotations

import hashlib
import re


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def found_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rule_measures(text: str | None) -> dict:
    text = text or ""
    words = found_words(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if found_words(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(words) < 50 or 100 * len(inside) > 50 * len(words),
    }


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?-i:([A-Za-z0-9+/_.=-]+))""", re.I | re.A
)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end), sorted."""
    text, spans = text or "", []
    # Python folds two letters beyond ASCII into s and k; they are no letters of a keyword.
    safe = text.replace("ſ", "\0").replace("K", "\0")
    spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(safe) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def simhash(text: str | None, k: int) -> int:
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = found_words(low)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_groups(fps: list[int], bits: int) -> list[int]:
    """For each fingerprint the least position its chain of close ones reaches."""
    group = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= bits and group[j] < group[i]:
                    group[i], changed = group[j], True
    return group
