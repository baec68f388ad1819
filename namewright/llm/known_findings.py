"""A generated set of labelled findings: what keys and tokens look like, and what looks a little like them.

The base patterns label only what they match themselves. This set is drawn by rule, without any corpus, so that a network
learns how random strings differ from names, paths and numbers, with and without telling words before them, and has both classes
however few findings a corpus holds. Nothing in it is a real key.
"""

from __future__ import annotations

import random
import string

Finding = tuple[str, str, str, bool]

HEX, UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"
LETTERS = string.ascii_letters
KEY = LETTERS + string.digits
LOWER_KEY, UPPER_KEY = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits

#: Prefixes of public token formats.
PREFIXES = ("ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "pk_test_", "rk_live_", "xoxb-", "xoxp-", "AIza", "npm_", "pypi-", "hf_", "SG.", "dop_v1_", "shpat_")

#: Words before a secret, and before settings that are none.
TELLING = (
    "key = ", "pwd: ", "pass=", "passphrase is ", "credentials: ", "Authorization: Bearer ", "bearer ", "access key ", "private_key: \"", "auth=", "client_id: ",
    "login with ", "signature=", "signing key '", "SECRET_KEY=\"", "use the key ",
)
SETTINGS = ("host = ", "path: ", "version = ", "file ", "see ", "import ", "class ", "id: ", "url=", "name: ", "date: ", "at ", "by ", "from ", "in ")

#: Words that names of files, modules and settings are made of.
PARTS = (
    "name", "file", "case", "test", "data", "user", "main", "list", "value", "index", "table", "config", "state", "page", "view", "get", "set", "time",
    "type", "code", "key", "window", "error", "path", "node", "image", "model", "query", "size", "date", "line", "text", "block", "event", "http", "json",
    "the", "of", "to", "old", "new", "first", "last", "max", "min", "long", "open", "read", "write", "server", "client", "report", "version", "public",
)

_ONSETS = ("b", "br", "c", "ch", "d", "f", "g", "gr", "h", "k", "l", "m", "n", "p", "qu", "r", "s", "sch", "st", "t", "tr", "v", "w", "z", "")
_VOWELS = ("a", "e", "i", "o", "u", "ei", "ie", "ou", "au", "ea")
_CODAS = ("", "", "n", "r", "s", "t", "l", "nd", "ng", "ch", "tion", "mente", "heit", "ing", "er")


def _word(draw: random.Random, syllables: int | None = None) -> str:
    n = syllables or draw.randint(1, 4)
    return "".join(draw.choice(_ONSETS) + draw.choice(_VOWELS) + draw.choice(_CODAS) for _ in range(n)) or "a"


def _part(draw: random.Random) -> str:
    return draw.choice(PARTS) if draw.random() < 0.5 else _word(draw, draw.randint(1, 2))


def _words(draw: random.Random, n: int) -> str:
    """Words around a finding; in places they are no words at all, which says nothing about the finding."""
    kind = draw.randrange(5)
    if kind == 0:
        return " ".join(_chosen(draw, draw.choice((string.ascii_lowercase, string.ascii_lowercase[:16], LOWER_KEY)), 2, 8) for _ in range(n + 2))
    return " ".join(draw.choice(PARTS) if kind == 1 else _word(draw) for _ in range(n))


def _chosen(draw: random.Random, letters: str, low: int, high: int) -> str:
    return "".join(draw.choices(letters, k=draw.randint(low, high)))


def _secret(draw: random.Random) -> str:
    kind = draw.randrange(10)
    if kind == 0:
        return _chosen(draw, draw.choice((HEX, UPPER_HEX)), 20, 64)
    if kind <= 3:
        return _chosen(draw, draw.choice((KEY, KEY, LOWER_KEY, UPPER_KEY)), 16, 48)
    if kind == 4:
        return _chosen(draw, KEY + "+/", 22, 64) + draw.choice(("", "=", "=="))
    if kind == 5:
        return draw.choice(PREFIXES) + _chosen(draw, draw.choice((KEY, LOWER_KEY, KEY + "_-")), 16, 40)
    if kind == 6:
        return "-".join(_chosen(draw, draw.choice((KEY, UPPER_KEY)), 4, 12) for _ in range(draw.randint(2, 4)))
    if kind == 7:
        return ".".join(("eyJ" + _chosen(draw, KEY, 15, 30), "eyJ" + _chosen(draw, KEY + "_-", 15, 80), _chosen(draw, KEY + "_-", 20, 43)))
    if kind == 8:
        return draw.choice(string.ascii_lowercase) + _chosen(draw, string.ascii_lowercase, 1, 3) + draw.choice("_-") + _chosen(draw, KEY, 18, 40)
    return _chosen(draw, KEY + "+/_-", 24, 100)


def _password(draw: random.Random) -> str:
    if draw.random() < 0.4:
        return _word(draw, 2) + _chosen(draw, string.digits + "_-+=", 2, 5) + _chosen(draw, LETTERS, 0, 3)
    return _chosen(draw, KEY + "+/_=-.", 8, 16)


def _clean(draw: random.Random) -> str:
    kind = draw.choice((*range(16), 1, 2, 3, 3))
    number = str(draw.randrange(10 ** draw.randint(1, 4)))
    if kind == 0:
        return f"{draw.choice(('mail', 'www', 'srv', _word(draw, 1)))}{draw.choice(('', number[:2]))}.{_word(draw, 2)}.{draw.choice(('com', 'org', 'net', 'de', 'example.com'))}"
    if kind == 1:
        return "/".join(_part(draw) + draw.choice(("", "", number)) for _ in range(draw.randint(2, 5))) + draw.choice(("", ".py", ".html", ".txt", "/"))
    if kind == 2:
        return "".join(_part(draw).capitalize() for _ in range(draw.randint(2, 4))) + draw.choice(("", number))
    if kind == 3:
        return draw.choice("_-").join(_part(draw) for _ in range(draw.randint(2, 5))) + draw.choice(("", "", "_" + number, number))
    if kind == 4:
        return f"{draw.randint(1900, 2099)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}" + draw.choice(("", f"T{draw.randint(0, 23):02}-{draw.randint(0, 59):02}", f"_{number}"))
    if kind == 5:
        return ".".join(str(draw.randint(0, 30)) for _ in range(draw.randint(3, 5))) + draw.choice(("", "-rc1", "-beta2", "-alpha.3", "+build5"))
    if kind in (6, 15):
        return "-".join(_chosen(draw, HEX, k, k) for k in (8, 4, 4, 4, 12))
    if kind == 7:
        return f"{_word(draw, draw.randint(2, 3))}.{number}"
    if kind == 8:
        return draw.choice(string.ascii_uppercase) * draw.randint(1, 2) + _word(draw, draw.randint(2, 3)) + draw.choice(("", ".", "-", number[:1]))
    if kind == 9:
        return draw.choice("=-_.+") * draw.randint(8, 70)
    if kind == 10:
        return f"{_part(draw)}-{_word(draw, 2)}" + draw.choice(("", ".", "-" + _part(draw)))
    if kind == 11:
        return str(draw.randrange(10**9, 10**14)) + draw.choice(("", ".00", "-1"))
    if kind == 12:
        return _word(draw, draw.randint(2, 4)) + number + draw.choice(("", ".", ".pdf", ".jpg", "_v2"))
    if kind == 13:
        return _part(draw).upper() + draw.choice("_-") + _word(draw, 2).upper() + draw.choice(("", "_" + number))
    return f"{_part(draw)}{draw.choice('.=')}{_word(draw, 2)}" + draw.choice(("", number))


def known_findings(n: int = 5000, seed: int = 5, context: int = 24) -> list[Finding]:
    """``n`` secrets and ``n`` others, each (characters before, body, characters after, whether a secret).

    A third of the secrets follow a telling word, and so does each one short enough to be a password; of the others some follow the name of a setting.
    """
    draw = random.Random(seed)
    out = []
    for i in range(2 * n):
        secret = i % 2 == 0
        short = secret and draw.random() < 0.2
        told = draw.choice(TELLING) if short or secret and draw.random() < 0.35 else draw.choice(SETTINGS) if draw.random() < 0.4 else ""
        before = f"{_words(draw, 4)}{draw.choice((' ', ' ', chr(10), ' (', ' '))}{told}"
        after = draw.choice((" ", "\n", ", ", "\" ", "' ", ") ")) + _words(draw, 4)
        if not secret and draw.random() < 0.08:
            # A host after the name of a mailbox.
            before, after = f"{_words(draw, 3)} {_word(draw, 1)}{draw.choice(('', str(draw.randrange(10_000))))}@", " " + _words(draw, 3)
            out.append((before[-context:], f"{_word(draw, 1)}{draw.choice(('', str(draw.randrange(99))))}.{_word(draw, 2)}.{draw.choice(('com', 'org', 'fr'))}", after[:context], False))
            continue
        body = _password(draw) if short else _secret(draw) if secret else _clean(draw)
        out.append((before[-context:], body, after[:context], secret))
    return out
