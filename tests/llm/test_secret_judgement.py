"""Which values after credential words are secrets: planted random ones are, words, addresses and prose aren't."""

import random
import string

import pytest

from lociq.llm import queries, secrets

PATH = queries.tokenizer_path()

ORDINARY = [
    "token: <your-token-here>", "token: https://example.com/path/to/page", "bearer: john.smith@example.com", "authorization: Kaltenbrunner", '"secret": "the recipe needs two eggs and a cup of flour, and so on"',
    "password: P@ssw0rd2024!", "api_key: ${API_KEY_FROM_ENV}", "token: see section 4.2", "auth: required", "pwd: Schmetterlingsflug", "secrets: /etc/ssl/private/server.key", "client_secret: {{ vault.client_secret }}",
    "auth=user.name+tag@mail.example.org", "bearer: Zwetschgendatschi", "password: hunter2", "auth: 2024-01-02T03:04:05Z", "pwd: $HOME/projects/app", "access_key: process.env.ACCESS_KEY_ID",
    "secrets: \"le secret d'une bonne soupe, c'est le temps et un peu de sel\"", "pwd: qwertyuiop12345", "credentials: abcabcabcabcabcabc", "authorization: Bearer <token>",
]


@pytest.mark.parametrize("text", ORDINARY)
def test_words_addresses_and_prose_are_no_secrets(text):
    assert [k for k, *_ in secrets.scan(text, PATH) if k == "guess"] == []


@pytest.mark.parametrize(("letters", "n", "least"), [
    (string.ascii_letters + string.digits, 12, 0.98), (string.ascii_letters + string.digits, 16, 0.99), (string.ascii_letters + string.digits + "!#$%&*+-?@^_", 12, 0.98),
    (string.ascii_letters + string.digits, 8, 0.94), (string.ascii_lowercase, 12, 0.9), (string.ascii_uppercase + string.digits, 20, 0.99),
])
def test_random_values_are_secrets(letters, n, least):
    rnd = random.Random(n)
    found = 0
    for _ in range(400):
        value = "".join(rnd.choice(letters) for _ in range(n))
        found += bool(secrets.scan(f"say pwd: {value} ok", PATH))
    assert found / 400 >= least


def test_the_hard_part_is_what_words_leave():
    for value, hard in (("summer-winter", False), ("summer-x7#Kq9!z", True), ("summer x7#K", False)):
        cost, parts = secrets.cheapest(value, PATH)
        assert (secrets.hard_cost(value, parts) >= secrets.GUESSES) == hard
        assert abs(sum(c for *_, c in parts) - cost) < 1e-9 and "".join(value[a:b] for a, b, _ in parts) == value
    assert secrets.cheapest("", PATH) == (0.0, [])


def test_pass_phrases_are_a_few_words():
    assert [k for k, *_ in secrets.scan('passphrase: "correct horse battery staple"', PATH)] == ["guess"]
    assert secrets.scan('token: "correct horse battery staple"', PATH) == []


def test_the_pipeline_takes_up_its_stages(spark, tmp_path):
    import corpus_pipeline

    sf, folder = "/root/testdata/sf0.001", str(tmp_path / "stages")
    times = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "stages").rglob("*.parquet")}
    first = sorted(map(str, corpus_pipeline.run(spark, sf, folder).drop("ids").collect()))
    before = times()
    assert len({p.parent.parent.name for p in before}) == len(corpus_pipeline.STAGES)
    assert sorted(map(str, corpus_pipeline.run(spark, sf, folder).drop("ids").collect())) == first and times() == before
