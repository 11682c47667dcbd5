"""Labelled findings for training the false-positive filter, made from rules with a fixed seed.

A finding is a path, the text before and after a candidate, the candidate and whether it is a secret. Real labelled
findings can be given instead; these cover the usual shapes of either kind.
"""
import random
from typing import NamedTuple


class Finding(NamedTuple):
    path: str
    before: str
    candidate: str
    after: str
    secret: bool


# What stands before a secret, and before what merely looks like one; words of identifiers and prose.
SECRET_NAMES = ["token", "api_key", "apiKey", "secret", "client_secret", "access_token", "auth_token", "password", "passwd", "private_key", "SECRET_KEY", "AWS_SECRET_ACCESS_KEY", "credential", "Bearer", "access_key", "signing_key"]
BENIGN_NAMES = ["commit", "sha1", "sha256", "md5", "checksum", "digest", "uuid", "id", "build", "revision", "etag", "integrity", "version", "trace", "order", "invoice", "file", "href"]
WORDS = ["user", "name", "value", "test", "data", "config", "server", "client", "service", "account", "number", "string", "example", "default", "manager", "handler", "request", "response", "session", "index", "count", "update", "create", "delete", "image", "public", "static", "final", "class", "method", "return", "internal", "module", "package", "project", "version", "release", "document", "report", "customer", "product", "order", "payment", "address", "email", "phone", "date", "time", "table", "column"]
PROSE = ["the", "of", "and", "with", "that", "was", "on", "for", "de", "la", "le", "que", "der", "die", "und", "en", "un", "est", "from", "this"]
PATHS = ["src/app/config.py", "deploy/prod.env", "settings.yaml", "notes.txt", "src3", "src0", "web/index.html", "README.md", "main.go"]
MOCK_PATHS = ["tests/test_auth.py", "docs/example.md", "fixtures/sample.json", "spec/mock_data.rb"]

_HEX, _LOWER, _UPPER, _DIGITS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_BASE64 = _UPPER + _LOWER + _DIGITS + "+/"


def labelled_findings(n: int = 4000, seed: int = 7) -> list[Finding]:
    """n findings, about half of them secrets."""
    rng = random.Random(seed)
    some = lambda alphabet, k: "".join(rng.choices(alphabet, k=k))
    prose = lambda: " ".join(rng.choices(PROSE + WORDS, k=rng.randint(2, 6)))

    def secret() -> str:
        kind = rng.randrange(11)
        return [
            lambda: some(_HEX, rng.choice([32, 40, 40, 48, 64])),
            lambda: some(_BASE64, rng.choice([24, 32, 40, 44, 64])),
            lambda: "AKIA" + some(_UPPER + _DIGITS, 16),
            lambda: rng.choice(["ghp_", "gho_", "ghs_"]) + some(_UPPER + _LOWER + _DIGITS, 36),
            lambda: rng.choice(["sk_live_", "rk_live_", "sk-"]) + some(_UPPER + _LOWER + _DIGITS, rng.choice([24, 32, 48])),
            lambda: "eyJ" + some(_BASE64, 33) + ".eyJ" + some(_BASE64, 60) + "." + some(_BASE64, 43),
            lambda: "xoxb-" + some(_DIGITS, 11) + "-" + some(_DIGITS, 11) + "-" + some(_UPPER + _LOWER + _DIGITS, 24),
            lambda: some(_UPPER + _LOWER + _DIGITS + "_-", rng.randint(20, 48)),
            lambda: some(_HEX, rng.randint(12, 24)),
            lambda: some(_LOWER + _DIGITS, rng.randint(10, 24)),
            lambda: some(_UPPER + _LOWER, rng.choice([20, 32, 40])),
        ][kind]()

    def benign() -> str:
        kind = rng.randrange(9)
        return [
            lambda: rng.choice(["_", "-", ".", "/", ""]).join(rng.choices(WORDS, k=rng.randint(3, 6))) + some(_DIGITS, rng.randint(0, 3)),
            lambda: "".join(w.title() for w in rng.choices(WORDS, k=rng.randint(3, 5))) + some(_DIGITS, rng.randint(0, 2)),
            lambda: some(_DIGITS, rng.randint(16, 24)),
            lambda: "-".join(some(_HEX, k) for k in (8, 4, 4, 4, 12)),
            lambda: rng.choice(["your", "my", "insert", "example", "dummy"]) + "_" + rng.choice(SECRET_NAMES).lower() + rng.choice(["_here", "_goes_here", "_1234", "_placeholder"]),
            lambda: rng.choice(["x", "0", "*", "a", "1"]) * rng.randint(16, 40),
            lambda: f"20{some(_DIGITS, 2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:00:00.{some(_DIGITS, 6)}",
            lambda: f"{rng.choice(['mail', 'www', 'host'])}{rng.randint(0, 99)}.{rng.choice(WORDS)}.{rng.choice(['com', 'org', 'net'])}",
            lambda: some(_HEX, rng.choice([32, 40, 64])),  # with a benign name before it
        ][kind]()

    out = []
    for i in range(n):
        wanted = i % 2 == 0
        candidate = secret() if wanted else benign()
        mock = rng.random() < (0.03 if wanted else 0.25)
        hexadecimal = not wanted and set(candidate) <= set(_HEX) and len(set(candidate)) > 4
        named = rng.random() < 0.85
        name = rng.choice(SECRET_NAMES) if (wanted and named) or (not wanted and not hexadecimal and rng.random() < 0.3) else rng.choice(BENIGN_NAMES) if hexadecimal or rng.random() < 0.5 else ""
        if wanted and name not in SECRET_NAMES and (set(candidate) <= set(_HEX + _LOWER) or candidate.isalpha()):
            name = rng.choice(SECRET_NAMES)  # a bare string of hexadecimal digits or of letters is a secret only under a name
        quote = rng.choice(['"', "'", ""])
        joint = rng.choice([" = ", "=", ": ", " "]) if name else " "
        out.append(Finding(rng.choice(MOCK_PATHS if mock else PATHS), f"{prose()} {name}{joint}{quote}", candidate, f"{quote} {prose()}", wanted))
    return out
