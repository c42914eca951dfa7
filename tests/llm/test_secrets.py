import hashlib
import random

from pressgrain.llm import secret_scan as S

LETTERS = "abcdefghijklmnopqrstuvwxyz"
VALUE = set(LETTERS + LETTERS.upper() + "0123456789+/_.=-")


def base_by_hand(text):
    """The three fixed kinds by scanning characters."""
    out, i = [], 0
    low = "".join(c.lower() if c.isascii() else c for c in text)
    while i < len(text):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(word, i):
                j = i + len(word)
                j += text[j : j + 1] in ('"', "'") and j < len(text)
                while text[j : j + 1] == " ":
                    j += 1
                if text[j : j + 1] not in (":", "="):
                    continue
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                # an optional quote; without it the value may start here
                k = j + (text[j : j + 1] in ('"', "'") and j < len(text))
                end = k
                while end < len(text) and text[end] in VALUE:
                    end += 1
                if end > k:
                    if end - k >= 6:
                        out.append((i, end, 0))
                    i = end - 1
                    break
        i += 1
    for kind, start, chars, least in ((1, "AKIA", LETTERS.upper() + "0123456789", 20), (2, "", "0123456789abcdef", 24)):
        i = 0
        while i < len(text):
            if text.startswith(start, i) and (start or text[i] in chars):
                end = i + len(start)
                while end < len(text) and text[end] in chars:
                    end += 1
                if end > i + len(start):
                    if end - i >= least:
                        out.append((i, end, kind))
                    i = end
                    continue
            i += 1
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_match_a_hand_written_scan(spark):
    rng = random.Random(2)
    bits = ["password", "Passwd", "SECRET", "tokEn", "api_key", "ApiKey", "ſecret", '"', "'", " ", " ", ":", "=", "abc123",
            "AKIA", "AKIAABCDEFGHIJ", "0123456789abcdef", "é", "\n", "deadbeef", "Zz9/+", "K"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "token=abcdefg"), (1002, "x" * 200_000 + " secret: abcdef12"), (0, "token=abcdefg")]
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, spans string")
    got = [tuple(r) for r in S.scan(docs).collect()]
    want = []
    for d, t in rows:
        base = base_by_hand(t or "")
        want.append((d, *(sum(k == x for *_, k in base) for x in range(3)), hashlib.sha256(S.joined(base).encode()).hexdigest()))
    assert sorted(((*r[:4], r[5]) for r in got), key=str) == sorted(want, key=str)
    assert S.scan(docs.limit(0)).count() == 0


def test_novel_strings_in_sensitive_context():
    random_part = "q7Vx2LmZ9pRw4KtB8sYc3NhD"
    text = f"The header was Authorization: Bearer {random_part} and nothing else."
    at = text.index(random_part)
    assert S.spans(text) == [(at, at + len(random_part), 3)]
    # the same string without such a context, a name made of known parts, and one that the text repeats
    assert S.spans(f"the build {random_part} is done") == []
    assert S.spans("the credential client_secret_token_configuration2 is a name") == []
    assert S.spans(f"{random_part} {random_part} was the cookie, {random_part} it was") == []


def test_long_random_strings_are_novel_in_any_alphabet():
    rng = random.Random(7)
    alphabets = ["0123456789ABCDEF", LETTERS.upper() + "234567", LETTERS + "0123456789", LETTERS + LETTERS.upper() + "0123456789+/"]
    for alphabet in alphabets:
        for n in (24, 40, 48, 64, 96, 128, 256, 344, 1000, 2000):
            value = "2F" + "".join(rng.choice(alphabet) for _ in range(n - 2))
            if not set(value) <= set(alphabet):
                value = "f2" + value[2:]
            text = f"The signature is {value} as sent by the build."
            at = text.index(value)
            assert S.spans(text) == [(at, at + n, 3)], value
            assert S.redacted(text) == "The signature is [SECRET] as sent by the build."
    # long strings made of known parts, of one part repeated, and of what the text says elsewhere
    assert S.spans("the credential " + "client_secret_authorization_environment2_" * 12) == []
    assert S.spans("the credential " + "q7Vx2LmZ9pRw4KtB8sYc3NhD" * 12) == []
    block = "".join(rng.choice(alphabets[3]) for _ in range(400))
    assert S.spans(f"{block} is public; its signature {block}") == []


ALPHABET = LETTERS + LETTERS.upper() + "0123456789"


def test_keys_of_many_lines_are_taken_whole():
    rng = random.Random(3)
    for k in range(120):
        body = "".join(rng.choice(ALPHABET + "+/") for _ in range(rng.choice([300, 800, 1216, 1601, 3000]))) + "=" * (k % 3)
        lines = [body[i : i + 64] for i in range(0, len(body), 64)]
        end, indent = rng.choice(["\n", "\r\n"]), rng.choice(["", "  ", "\t"])
        armour = rng.choice(["RSA PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY"])
        text = f"It was sent.\n-----BEGIN {armour}-----{end}{end.join(indent + x for x in lines)}{end}-----END {armour}-----{end}Then the text goes on."
        got = {i for a, b, _ in S.spans(text) for i in range(a, b)}
        at = 0
        for line in lines:
            at = text.index(line, at)
            assert set(range(at, at + len(line))) <= got
            at += len(line)
        assert "Then the text goes on." in S.redacted(text) and "It was sent." in S.redacted(text)


def test_tokens_of_several_parts_are_taken_whole():
    rng = random.Random(4)
    for _ in range(120):
        parts = ["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9"] + ["".join(rng.choice(ALPHABET + "-_") for _ in range(n)) for n in (rng.randint(40, 200), 43)]
        token = ".".join(parts)
        text = f"curl -H 'Authorization: Bearer {token}' https://example.com/list and the rest"
        got = {i for a, b, _ in S.spans(text) for i in range(a, b)}
        at = text.index(token)
        assert all(i in got or text[i] == "." for i in range(at, at + len(token)))
        assert S.redacted(text).endswith("' https://example.com/list and the rest")


CLEAN = [
    "The api key is document-version-2024-final as filed.", "the cookie preferences_screen_layout_v2 was set",
    "auth build/output/release_2024_notes", "the secret https://docs.example.com/path/to/the/handbook-2024/page_12",
    "the credential client_secret_token_configuration2 is a name", "token TokenRefreshHandlerFactory2Implementation used",
    "signature verification-module-version-10-stable is ok", "password-reset-link-expiry-2023-policy",
    "bearer com/example/project/ServiceAccountKeyProvider3", "access key rotation-schedule_q3_2025.md",
]


def test_names_paths_and_prose_are_left_alone():
    assert [S.spans(x) for x in CLEAN] == [[]] * len(CLEAN)
    # names of random words in sensitive context: fewer than one in a hundred is reported
    rng = random.Random(5)
    syllables = [a + b + c for a in ("b", "c", "d", "f", "l", "m", "pr", "r", "s", "st", "t", "v") for b in "aeiou" for c in ("", "n", "r", "s", "l")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    alarms = 0
    for _ in range(1000):
        sign = rng.choice("-_/")
        name = sign.join([word() for _ in range(rng.randint(3, 6))] + [str(rng.randint(1, 2030))])
        alarms += bool(S.spans(f"the {rng.choice(['api key', 'token', 'cookie', 'auth'])} {name} is named so"))
    assert alarms < 10


def test_random_strings_are_found_though_some_look_like_words():
    rng = random.Random(6)
    for alphabet, least in ((ALPHABET, 0.99), (LETTERS + "0123456789", 0.97), (LETTERS.upper() + "234567", 0.97), ("0123456789ABCDEF", 0.99)):
        hits = 0
        for _ in range(400):
            value = "".join(rng.choice(alphabet) for _ in range(32))
            text = f"the bearer {value} was sent"
            known = not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value))
            hits += known or any(text[a:b] == value for a, b, _ in S.spans(text))
        assert hits >= least * 400, alphabet


def test_redacted():
    text = 'a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### b'
    assert S.redacted(text) == 'a [SECRET]"### b'
    assert S.redacted("clean text") == "clean text"
