import base64
import json

import pytest

from loamstack.llm import credentials as C

TOKEN = "gh" + "p_" + "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dE3fG5"
WORD = "Kestrel#moor" + "48213"
BASIC = base64.b64encode(f"svc_a:{WORD}".encode()).decode()
JWT = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": "abc", "n": 12})) + ".aZ3_-xY9kLmN0pQrS"

FOUND = [
    (f'token = "{TOKEN}"', "python", 1), (f"x = '{TOKEN}'", "python", 1), (f'db_password = "{WORD}"', "python", 1), (f'login("svc_a", "{WORD}")', "go", 1), (f"// old account svc_a, pw={WORD}", "c", 1),
    (f'url = "postgres://svc_a:{WORD.replace("#", "_")}@db.example:5432/x"', "python", 1), (f"AUTH=Basic {BASIC}", "dotenv", 1), (f'h = "Bearer {JWT}"', "javascript", 1), (f"curl -u svc_a:{WORD} https://h.example/", "shell", 1),
    (f'#define DB_PASSWORD "{WORD}"', "c", 1), ('k = """-----BEGIN RSA PRIVATE ' + 'KEY-----\nMIIEvQIBADANBgkqhkiG9w0BAQEFAASC\n-----END RSA PRIVATE KEY-----"""', "python", 1), (f'const T: &str = concat!("{TOKEN[:20]}", "{TOKEN[20:]}");', "rust", 1),
    (f"\n\nadmin_password: '{WORD}'", "yaml", 3), ('u = "https://h.example/v1/a?sig=' + 'Zx9Kq2Lm8Np4Rt6Vw1Yb"', "python", 1),
]
CLEAN = [
    'password = os.environ["PASSWORD"]', 'api_key = "YOUR_API_KEY_HERE"', 'secret = "xxxxxxxxxxxxxxxx"', 'token = "${TOKEN}"', 'token = "<token>"', 'secret_name = "vault/a/secret"', 'password_hint = "at least 12 letters"', 'token = wrap(value_3, limit=61)', 'late_token = "local grammar packs"',
    'public_key = "-----BEGIN PUBLIC KEY-----aB3dE5gH7jK9mN1pQ3sT5vW7-----END PUBLIC KEY-----"', 'sha256 = "980060a0578adc3e9cbd44cb6cff523a95eb4f0205ea3970bd920d2d1d3e91c5"', 'etag = "P32BhP7yjvXBLSSCnJAGF9Thpr8r"', 'run --token "late-38749"', "-----BEGIN PRIVATE " + "KEY----- is the opening line",
]


@pytest.mark.parametrize("text,lang,line", FOUND)
def test_found_and_redacted(text, lang, line):
    s = C.find(text, lang)
    assert s and text.count("\n", 0, s[0][0]) + 1 == line
    out = C.redact(text, s)
    assert len(out) == len(text) and out != text and out.count("\n") == text.count("\n")
    assert WORD not in out and TOKEN not in out and TOKEN[20:] not in out and BASIC not in out
    a, b = s[0][0], s[-1][1]
    assert out[:a] == text[:a] and out[b:] == text[b:]


@pytest.mark.parametrize("text", CLEAN)
def test_not_found(text):
    assert C.find(text, "python") == []


def test_rows(spark):
    rows = [(1, None, None, None, "k"), (2, "", "", "", "k"), (3, f'password = "{WORD}"', f"/d/x-token:{TOKEN}@h.example/a", " Python ", None), (3, f'password = "{WORD}"', None, "python", "k"), (4, "a " * 400_000 + f"\npassword = '{WORD}'", "p", "python", "k")]
    df = spark.createDataFrame(rows, "id int, content string, file_path string, language string, cred_findings string")
    got = C.find_credentials(df).collect()
    assert [[f.line_no for f in r.cred_findings] for r in got] == [[], [], [0, 1], [1], [2]]
    assert got[0].cred_text is None and got[1].cred_text == "" and TOKEN not in got[2].cred_path
    assert C.find_credentials(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [f'c="Server=h;User=svc_a;Password={WORD};Pool=3"', f'password:"{WORD}{{x;y}}Q7"', 'password="' + "aB3xK9" * 1500 + '"', f'token="{TOKEN}"', f'url="postgres://svc_a:{WORD.replace("#", "_")}@db.example:5432/x"'])
@pytest.mark.parametrize("shift", [0, 1985, 3995, 7990])
def test_long_lines_as_short_ones(piece, shift):
    pad = "f(a,b);" * 4000
    before = "g(c);" * (shift // 5)
    want = [(a + len(pad) + len(before) + 1, b + len(pad) + len(before) + 1, k) for a, b, k in C.find(" " + piece + ";", "javascript")]
    assert want and C.find(pad + before + "  " + piece + ";" + pad, "javascript") == want


@pytest.mark.parametrize("text,lang", [(f'db_pw = "{WORD}"', "python"), (f"pw: {WORD}", "yaml"), (f"# pw is {WORD}", "python"), (f'x = "ghu_{TOKEN[4:]}"', "python"), (f'x = "ghr_{TOKEN[4:]}"', "python"), ("/v1/a?sig=Zx9Kq2Lm8Np4Rt6Vw1Yb", "text"), ("a?signature=Zx9Kq2Lm8Np4Rt6Vw1Yb", "text"), (f'open(host, "svc_a", "{WORD}")', "go"), (f'sign_in("svc_a", "{WORD}")', "ruby"), (f'Client(host, "svc_a", "{WORD}")', "python"), (f"fetch -u svc_a:{WORD} h", "shell")])
def test_every_anchor_is_a_keyword(text, lang):
    assert C.find(text, lang)


def test_masks_keep_the_alphabet():
    assert C._mask("deadbeef0123") == "aaaaaaaa0000" and C._mask("DEADBEEF0123") == "AAAAAAAA0000"
    bytes.fromhex(C._mask("9f86d081884c7d65"))
    base64.b32decode(C._mask("JBSWY3DPEHPK3PXPJBSWY3DPEHPK3PXP"))
    assert base64.b64decode(C._mask(BASIC)) and len(C._mask(WORD)) == len(WORD) and C._mask("aB3-x_Y") == "xX0-x_X"


def test_checksums_prove_tokens():
    import zlib

    body, digits, n = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1", "", zlib.crc32(b"aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1")
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[d] + digits
    good = "gh" + "p_" + body + digits
    assert C.has_checksum(good) and not C.has_checksum(TOKEN) and C.verified("github", good) and C.verified("jwt", JWT) and not C.verified("password", WORD)
    for t in (good, TOKEN):  # one that proves nothing may be live all the same
        assert C.find(f'x = "{t}"', "python")


def test_many_adjacent_literals():
    parts = [f"aB3xK9qT{k:02d}" for k in range(30)]
    text = 'x = "ghp_' + 'a1B2c3D4e5"\n  "'.join(parts) + '"\n'
    s = C.find(text, "python")
    out = C.redact(text, s)
    assert len({text.count("\n", 0, a) for a, _, k in s if k != "continued"}) == 1 and not any(p in out for p in parts)
