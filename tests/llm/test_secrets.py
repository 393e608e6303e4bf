import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

import pytest

from touchledger.llm import secrets

# The patterns as the contract has them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def plain(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PIECES = st.sampled_from(["token", "Secret", "API_KEY", "apikey", "password", "=", ":", " ", '"', "'", "abc", "ABCDEF12", "AKIA", "\n",
                          "0123456789abcdef01234567", "é", "ſecret", "toKen", "deadbeef", "+x/", "${A}", "A", "B=", "'s3cr3t-Pa55w0rd'"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    n_assign, n_access, n_hex, digest, spans = secrets.scan(text)
    want = plain(text)
    assert digest == hashlib.sha256(want.encode()).hexdigest()
    assert (n_assign, n_access, n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    base = [s for s in spans.split(",") if s and not s.startswith("lexed")]
    assert ",".join(base) == want


def literals(text):
    return [text[a:b] for a, b in secrets.lexed_spans(text)]


def test_names_decide_which_literals_are_secret():
    assert literals('DB_PWD = "x7Gq!9zT2w"') == ["x7Gq!9zT2w"]
    assert literals("dbPassphrase: 'k3yW!th-punct'") == ["k3yW!th-punct"]
    assert literals('{"private-key": "MIIEvQ+7a/9Kx=="}') == ["MIIEvQ+7a/9Kx=="]
    assert literals("colour = \"x7Gq!9zT2w\"") == []
    assert literals('password_hint = "x7Gq!9zT2w"') == [] and literals("token_count = 1234567890") == []
    assert literals('pwd = "changeme"') == [] and literals("pwd = <your password>") == []
    assert literals('if pwd == "x7Gq!9zT2w":') == []


def test_constants_carry_their_literals_on():
    text = 'K = "Zx81-qq7/Rt"\nsettings.colour = "Zx81-other/Rt"\nclient(db_password=K)\n'
    assert literals(text) == ["Zx81-qq7/Rt"]
    assert literals('BASE = "Ab9-"\nFULL = BASE + "cD3!efG7"\nexport AUTH_TOKEN=${FULL}') == ["Ab9-", "cD3!efG7"]
    assert literals('A = B\nB = A\npasswd = A') == []


def test_spans_count_code_points_and_are_not_reported_twice():
    text = 'é漢 secret = "abcdef99"; creds = "Qw3rty-uiop9"'
    spans = secrets.scan(text)[4].split(",")
    assert spans[0].startswith("assign:3:") and [s for s in spans if s.startswith("lexed")] == [
        f"lexed:{text.index('Qw3')}:{text.index('Qw3') + 12}"]


def test_documents_with_nulls_and_clashing_columns(llm, documents):
    docs = documents((1, None, "x"), (2, "", "x"), (3, 'token="abcdef"', "x"), (3, 'token="abcdef"', "x"), (None, "a " * 300_000, "x"),
                     schema="doc_id bigint, text string, spans string")
    got = sorted(((r["doc_id"], r["n_assign"], r["spans"]) for r in secrets.find_secrets(docs).collect()), key=str)
    assert got == sorted([(1, 0, ""), (2, 0, ""), (3, 1, "assign:0:13"), (3, 1, "assign:0:13"), (None, 0, "")], key=str)
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_constants_are_put_into_the_expressions_that_use_them():
    assert literals('A = "abcd"; B = "efg9!"; password = A + B') == ["abcd", "efg9!"]
    assert literals('BASE = "Ab9-"\nFULL = BASE + "cD3!efG7"\nexport AUTH_TOKEN=${FULL}') == ["Ab9-", "cD3!efG7"]
    assert literals('A = "abcd"\nA = A + "Ef9!"\npwd = A') == ["abcd", "Ef9!"]
    assert literals('A = "abcd"\nA = "zZ8"\npwd = A + "Ef9!"') == ["zZ8", "Ef9!"]
    assert literals('pwd = A + "x9!"\nA = "abcd"') == ["x9!", "abcd"]
    assert literals('A = "abcd"; B = "efg9!"; colour = A + B') == []
    assert literals('A = B + "k"\nB = A + "j"\npwd = A + B') == []
    long = 'A0 = "q"\n' + "".join(f"A{i} = A{i - 1} + A{i - 1}\n" for i in range(1, 60)) + 'passwd = A59 + "Zt4!bN"'
    assert literals(long)[-1] == "Zt4!bN"
    assert literals("".join(f"A{i} = A{i + 1}\n" for i in range(5000)) + 'A5000 = "aB3"\npwd = A0 + "cD4!"') == ["aB3", "cD4!"]


@pytest.mark.parametrize("make", [
    lambda n: "\n".join(f'password{k + 1} = password{k} + "x{k}"' for k in range(n)),
    lambda n: "\n".join(f'password{k} = "aB3dE{k}x9!"' for k in range(n)),
    lambda n: 'secret0 = "aB"\n' + "\n".join(f"secret{k + 1} = secret{k} + secret{k}" for k in range(n)),
    lambda n: "\n".join(f"token{k} = token{(k + 1) % n}" for k in range(n))])
def test_ten_times_the_lines_take_about_ten_times_as_long(make):
    import time

    def seconds(n):
        text, began = make(n), time.process_time()
        secrets.scan(text)
        return time.process_time() - began
    seconds(100)
    assert seconds(10_000) < 40 * seconds(1_000) + 0.5


def test_a_value_of_any_number_of_parts_is_scored_whole():
    doubled = 'k0 = "aB"\n' + "".join(f"k{i} = k{i - 1} + k{i - 1}\n" for i in range(1, 200)) + 'password = k199 + "7!"'
    assert literals(doubled) == ["aB", "7!"]
    assert literals('k0 = "x"\n' + "".join(f"k{i} = k{i - 1} + k{i - 1}\n" for i in range(1, 40)) + "password = k39") == []


def test_strength_is_that_of_the_text():
    for text in ("x7Gq!9zT2w", "abcdef", "changeme", "a b c d e f", "x" * 3000, "Ab1!" * 900):
        parts = secrets.Value()
        for c in text:
            parts.add(secrets.Value.of(c))
        assert parts.strength() == secrets.strength(text) == secrets.Value.of(text).strength()
