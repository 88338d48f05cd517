"""Plain-Python statements of the text rules, for comparison on random strings."""

from __future__ import annotations

import random
import re

CHARACTERS = [
    "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0",
    "\u1680", "\u2003", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\ufeff", "\u200b",
    "\u180e", "a", "b", "é", "😀",
]
COMMAND_TOKENS = [
    "$", "#", "%", ">", "PS ", "PS>", "PS C:\\> ", "C:\\", "λ", "rem ", "REM ", "::", ";", "//",
    "ls", "bash", "BASH", "dir", "$HOME", " ", "  ", "\t", "\u2003",
]
PROMPTS = ["$", "#", "%", ">", "PS ", "PS>", "PS C:\\", "C:\\", "λ"]


def random_texts(n: int, alphabet: list[str], longest: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(n)]


def truncated(content: str, width: int) -> str:
    return "\n".join(line[:width] for line in content.splitlines())


def normalised(content: str, whitespace: bool, strip: bool, width: int | None) -> str:
    if whitespace:
        content = re.sub("[\t\x0b\x0c\r]+", " ", content)
    if strip:
        content = re.sub("\n\n\n+", "\n\n", content.strip())
    return truncated(content, width) if width else content


def windows(content: str, size: int, overlap: int) -> list[tuple[int, int, str]]:
    """Windows by their definition: all starts at multiples of the step, up to the first
    window that reaches the last line."""
    lines = content.splitlines()
    found = []
    for start in range(0, len(lines), size - overlap):
        end = min(start + size, len(lines))
        found.append((start + 1, end, "\n".join(lines[start:end])))
        if end == len(lines):
            break
    return found


def looks_binary(data: bytes) -> bool:
    allowed = {7, 8, 9, 10, 12, 13, 27}
    return any(b < 32 and b not in allowed for b in data)


def decoded(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def command_of(line: str, shells: set[str]) -> str | None:
    """Command in one line, or None."""
    line = line.strip()
    if not line or re.match(r"#|//|rem |::|;", line.lower()):
        return None
    prompt = next((p for p in PROMPTS if line.startswith(p)), None)
    if prompt is not None:
        line = line.removeprefix(prompt).lstrip()
    command = " ".join(line.split())
    return None if not command or command.lower() in shells else command


def slug(name: str, fallback: str) -> str:
    return re.sub(r"[^\w-]", "-", name.strip().lower()).strip("-") or fallback
