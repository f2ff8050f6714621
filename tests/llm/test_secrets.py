import re

import pytest

import brute
from linkgraph.llm import secrets

A, B = "Zx9Qw7Lm2Pk4", "b81f00aa72cc"


def base(text):
    """The fixed patterns, matched by the letter of their definition."""
    out = []
    key = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) \
        + "|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return ",".join(x[2] for x in sorted(out))


TEXTS = [
    "", "token = short", "TOKEN:abcdefgh", "api_key='aaaaaaaa' apikey=bbbbbbbb api__key=cccccccc", "toKen=abcdefgh paſſwd=abcdefgh",
    "é token = " + A, "AKIA" + "A" * 11, "AKIA" + "A1" * 8 + "b", "0" * 31, "f" * 32 + "g" + "0123456789abcdef" * 4,
    "secret: password=abcdefgh", "password  =  \"" + A + "\"", "password\n=abcdefgh", "x" * 5000 + " token=" + A + " " + "y" * 5000,
    "token = token = token = abcdefgh", "secret=" + "=" * 9, "a0" * 100_000, "token=" + "f" * 40,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    got = [s for s in secrets.secret_spans(text) if s[2] != "pair"]
    assert ",".join(f"{k}:{a}:{b}" for a, b, k in got) == base(text)


def found(text):
    return [text[a:b] for a, b in secrets.pair_spans(text)]


@pytest.mark.parametrize("text,literals", [
    (f'private_key = "{A}"', [A]), (f"authToken: '{A}'", [A]), (f'{{"client_secret": "{A}", "name": "{B}"}}', [A]),
    (f"export DB_PASSWORD={A}\n", [A]), (f"dbPwd := `{A}`", [A]), (f'"signing_key" => "{A}"', [A]),
    (f'part = "{A}"\nother = 3\napi_secret = part', [A]), (f'a = "{A}"; b = a + "{B}"; passphrase = b + "x"', [A, B, "x"]),
    (f"k={A}\nauth_token=${{k}}", [A]), (f'a = "{A}"\na = "{B}"\nsecret = a', [B]), (f'cfg.password = "{A}"', [A]),
    ('token_count = "123456789a"', []), (f'secret_name = "{A}"', []), (f'public_key = "{A}"', []), (f"colour: {A}", []),
    ("password = get_password()", []), ('password = "your-password-1"', []), ('password = "correct horse 1"', []),
    (f'if token == "{A}":', []), ("secret = ", []), ('secret = "unterminated', []), ("= : := =>", []), (f'password != "{A}"', []),
    ("Secret: of the old town, they said", []),
])
def test_pairs(text, literals):
    assert found(text) == literals or sorted(found(text)) == sorted(literals)


@pytest.mark.parametrize("text", [
    f'pwd: str = "{A}"', f'def f(n: int, pwd: str="{A}"):', f'self.pwd: Optional[str] = "{A}"', f'pwd: str | None = "{A}"',
    f"const dbPwd: string = '{A}'", f"pwd?: string = '{A}'", f"let pwd: string | null = '{A}'", f'let pwd: &\'static str = "{A}"',
    f'var pwd string = "{A}"', f'var (\n\tuser string = "u"\n\tpwd string = "{A}"\n)', f'const pwd string = "{A}"', f'var pwd Hidden = "{A}"',
    f'config["db_pwd"] = "{A}"', f"os.environ['API_KEY'] = '{A}'", f'$c["a"][ "pwd" ] = "{A}"', f'c[:pwd] = "{A}"', f'c["pwd"][0] = "{A}"',
    f'char pwd[32] = "{A}"', f'const string pwd = "{A}"', f'part: str = "{A}"\npwd: str = part', f"private_key: {A} = note",
])
def test_types_and_subscripts(text):
    assert found(text) == [A]


@pytest.mark.parametrize("text", [
    f'user: str = "{A}"', f'pwd: str\nother = "{A}"', f'c["name"] = "{A}"', f'c["pwd"] == "{A}"', f'c["part"] = "{A}"\npwd = part',
    f'var user string = "{A}"', f'{{ pwd: string; other: string }}\nx = "{A}"',
])
def test_types_and_subscripts_of_other_names(text):
    assert found(text) == []


@pytest.mark.parametrize("literal", ["MyS3cretPw99", "YourS3cretPw99", "Change4Zx9Qw7", "none4Zx9Qw7Lm", "nullZx9Qw7Lm2", "todoZx9Qw7Lm2", "exampleZx9Qw7",
                                     "xxxZx9Qw7Lm2Pk4", "***Zx9Qw7Lm2", "<Zx9Qw7Lm2Pk4", "my-Zx9Qw7Lm2Pk4", "sampleZx9Qw7"])
def test_a_secret_may_start_like_a_placeholder(literal):
    assert found(f'db_pwd = "{literal}"') == [literal]


@pytest.mark.parametrize("literal", ["your-password-1", "changeme123", "CHANGE_ME_123", "my-api-key-1", "example_token_1", "<your-Token-1>", "****ab12",
                                     "xxxxxxxx1234", "REDACTED-2024", "todo:set-1", "Dummy-Pass-12"])
def test_placeholders(literal):
    assert found(f'db_pwd = "{literal}"') == []


@pytest.mark.parametrize("name", ["db_pass", "pass", "dbPass", "aws_creds", "cookie", "session_cookie", "auth", "basic_auth", "authorization",
                                  "access_key", "accessKey", "ssh_key", "session_key", "master_key", "client_key", "deploy_key", "sshkey"])
def test_sensitive_names(name):
    assert found(f'{name} = "{A}"') == found(f'{name}: "{A}"') == [A]


@pytest.mark.parametrize("name", ["sort_key", "primary_key", "public_key", "ssh_public_key", "access_key_id", "auth_type", "author", "bypass", "access_count",
                                  "session_id", "cookie_name"])
def test_other_names(name):
    assert found(f'{name} = "{A}"') == []


P = "otter violin ladder mosaic"


@pytest.mark.parametrize("text,literals", [
    (f'pwd = """{A}"""', [A]), (f"pwd = '''\n  {A}\n'''\n", [A]), (f'pwd = """{A}\n  {B}\n"""', [f"{A}\n  {B}"]),
    (f'user, pwd = "root", "{A}"', [A]), (f'pwd, user = "{A}", "{B}"\n', [A]), (f"const [user, pwd] = ['root', '{A}'];", [A]),
    (f'user, pwd := "root", "{A}" // note\n', [A]), (f'user, pwd = get("x"), "{A}"\n', [A]), (f'f(user, pwd="{A}", n=3)', [A]),
    (f'connect(\n  user, pwd="{A}",\n  n=3)', [A]), (f'user, part = "root", "{A}"\nsecret_value = part', [A]),
    (f'pwd = ("{A}"\n       "{B}")', [A, B]), (f'pwd = (\n  "{A}" +\n  "{B}"\n)', [A, B]), (f'pwd = "{A}" +\n  "{B}";', [A, B]),
    (f'pwd = "{A}"\n  + "{B}";', [A, B]),
    (f'#define DB_PWD "{A}"\n', [A]), (f'# define PART "{A}"\nconst char *pwd = PART;', [A]),
    (f"<private-key>{A}</private-key>", [A]), (f'<db:pwd type="x">\n {A}\n</db:pwd>', [A]), (f"<pwd><![CDATA[{A}]]></pwd>", [A]),
    (f'<add key="Pwd" value="{A}"/>', [A]), (f"<add value='{A}' name='Pwd' />", [A]), (f'<property name="db.pwd">{A}</property>', [A]),
    (f'<script>var pwd = "{A}"</script>', [A]),
    (f"private_key: |\n  -----BEGIN RSA PRIVATE KEY-----\n  MIIEow\n  {A}==\n  -----END RSA PRIVATE KEY-----\nother: 1\n",
     [f"-----BEGIN RSA PRIVATE KEY-----\n  MIIEow\n  {A}==\n  -----END RSA PRIVATE KEY-----"]),
    (f"a:\n  - pwd: >-  # note\n      {A}\n    name: {B}\n", [A]), (f"app: |\n  pwd={A}\n", [A]), (f"pwd: |\r\n  {A}\r\n", [A]),
    (f'"pwd"\n  : "{A}"', [A]), (f'pwd\n    = "{A}";', [A]), (f'pwd:\n  "{A}"\n', [A]), (f'pwd = \\\n  "{A}"', [A]),
    (f'conn = "Server=db;User Id=sa;Pwd={A};Encrypt=no"', [A]), (f'dsn = "host=db pwd = {A} port=1"', [A]), (f'u = "http://h/?n=1&auth={A}&m=2"', [A]),
    (f'auth = "Bearer {A}"', [f"Bearer {A}"]), (f'passphrase = "{P}"', [P]), (f"seed_phrase: '{P}'", [P]),
])
def test_forms_over_lines_and_markup(text, literals):
    assert found(text) == literals or sorted(found(text)) == sorted(literals)


@pytest.mark.parametrize("text", [
    f'user, name = "{A}", "{B}"', f'pwd, user = get(), "{A}"', f'#define USER "{A}"', f"<user>{A}</user>", f'<add key="User" value="{A}"/>',
    f'<add key="Pwd" value=""/>{A}', f"<pwd>{A}</user>", f"<pwd>{A}", f"description: |\n  {A}\npwd: |\nother: {A}\n", f'pwd:\n"{A}": 1\n',
    f'conn = "Server={A};User={B}"', 'password = "please enter the password"', 'passphrase = "three small words"', 'pwd = "too many of your words"',
    'auth = "Basic authentication"', 'pwd = "Mixed Case Title Words Here"', f'passphrase = "{P} {P}"', 'pwd = """"""', 'pwd = ("', "pwd = (\n", "pwd: |",
    "pwd: |\n\n", f"Pwd\n: see {A} and more", "key_phrase = 'Zx9Qw7Lm2Pk4'", 'pwd = """\nLong Text of 3 lines\n and one Word\n"""',
])
def test_forms_that_hold_no_secret(text):
    assert found(text) == []


def test_the_end_of_a_docstring_is_no_value():
    assert found(f'def f():\n    """Raises:\n    """\n\npwd = "{A}"\n"""End."""') == [A]


def test_a_pair_inside_a_pair_adds_nothing():
    text = f'auth_string = "Pwd={A}"'
    assert [(text[a:b], k) for a, b, k in secrets.secret_spans(text)] == [(f"Pwd={A}", "pair")]


@pytest.mark.parametrize("unit", ['a="""', "a='''x", 'a="""\\', "pwd: |\n  ", "<a ", "<a b='", "<a>", "<pwd>x", "a,b=", "a, b = x,\n", "a, b = c(", "a=(\n", 'a\n=', "a=\n",
                                  "#define a ", '#define a "', 'a="b=', "a = 'x" + "y" * 50, "pwd: |\n", 'a="x"\n+', "<a b='' ", 'a="x=y;', "a,", "a = b;"])
def test_long_forms_are_linear(unit):
    import time
    start = time.time()
    secrets.secret_spans("x: " + unit * (400_000 // len(unit)) + " = 'x'")
    assert time.time() - start < 10


def test_pairs_inside_base_spans_add_nothing():
    text = f'password = "{A}"\nsession_token_key = "{A} "'
    assert [s[2] for s in secrets.secret_spans(text)] == ["assign"]


@pytest.mark.parametrize("unit", ['a = a + a\n', '="', "='\\", ": ", "a:", "password=", '"', "x = y;", "token: 'a", "a=b+", "==", "-="])
def test_long_input_is_linear(unit):
    import time
    start = time.time()
    secrets.secret_spans('a = "' + A + '"\n' + unit * (400_000 // len(unit)) + "\npassword_secret = a")
    assert time.time() - start < 10


def test_scan(spark):
    rows = [(1, f"token = {A}", "x", None), (1, f"token = {A}", "x", None), (None, None, "x", 1), (3, "é𝕏 AKIA" + "B" * 16, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, start int")
    got = sorted((repr((r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]])) for r in secrets.scan(df).collect()))
    assert got == sorted(map(repr, [(1, [("assign", 0, 20)])] * 2 + [(None, []), (3, [("access", 3, 23)])]))
    assert secrets.scan(df.limit(0)).collect() == []


def test_query_on_the_test_table(spark):
    from linkgraph.llm.queries import op2_secret_scan

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op2_secret_scan(spark, "/root/testdata/sf0.001").collect():
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == brute.sha(want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(want.count(k) for k in ("assign", "access", "hex"))
        assert [x for x in r["spans"].split(",") if x and not x.startswith("pair")] == [x for x in want.split(",") if x]


@pytest.mark.parametrize("unit", ["a::a", "x: a<b>|a<b>|", "x: a<", '"]', '["a"] = ', "a b =", "[0]", "a?:", "x: a["])
def test_long_types_and_subscripts_are_linear(unit):
    import time
    start = time.time()
    secrets.secret_spans("x: " + unit * (400_000 // len(unit)) + " = 'x'")
    assert time.time() - start < 10
