"""Hashes of lines against their plain definition."""

import numpy as np

from textmill.llm import line_dedup


def test_windows_signatures_and_sets_are_as_defined(monkeypatch):
    def plain(line):
        found = []
        for i in range(len(line) - line_dedup.SHINGLE + 1):
            x = 0
            for c in line[i : i + line_dedup.SHINGLE]:
                x = (x * 0x100000001B3 + ord(c)) % 2**64
            x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 % 2**64
            found.append(x ^ (x >> 29))
        return found

    monkeypatch.setattr(line_dedup, "PIECE", 40)
    lines = ["12345678", "aaaaaaaaaaaa", "ab\U0001f600" * 30, "a line of some words, a line of some words"]
    signatures = line_dedup.sketches(lines)
    for line, signature in zip(lines, signatures, strict=True):
        hashes = plain(line)
        assert line_dedup.shingle_set(line).tolist() == sorted(set(hashes))
        assert signature.tolist() == [min((h >> 32) * int(t) % 2**32 for h in hashes) >> 3 & 255 for t in line_dedup._TIMES]
