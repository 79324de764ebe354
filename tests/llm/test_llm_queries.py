"""The registered queries themselves, against plain versions of what they must return."""

import hashlib

from llm_cases import documents, frame
from test_llm_text import SECRET_TEXTS, plain_personal, plain_secrets

from series_lake.llm import pii_crf, secrets
from series_lake.llm.queries import QUERIES

PERSONAL_TEXTS = [
    "a@b.co, c.d@e-f.org 10.0.0.1 4111 1111 1111 1111 +49 (0)30 123456",
    "1.2.3.4 5.6.7.8 9.10.11.12 999.1.1.1 x@y.zz",
    "+1 555 010 99 77 and +44 20 7946 0958 and 4012888888881881",
]


def folder(spark, tmp_path, rows):
    frame(spark, rows, clashes=False).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def digest(spans, names, order):
    return hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for k, a, b in sorted(spans, key=order)).encode()).hexdigest()


def test_personal_data_query(spark, tmp_path):
    rows = [*documents(), *[(400 + i, t, None, None) for i, t in enumerate(PERSONAL_TEXTS)]]
    got = QUERIES["op4_pii_crf"](spark, folder(spark, tmp_path, rows)).collect()
    want = []
    for doc_id, text, *_ in rows:
        spans = plain_personal(text or "")
        want.append((str(doc_id), *[sum(s[0] == k for s in spans) for k in range(4)], digest(spans, pii_crf.KINDS, lambda s: s[:2])))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
    assert len({tuple(w[1:5]) for w in want}) > 3


def test_secrets_query(spark, tmp_path):
    rows = [*documents(), *[(400 + i, t, None, None) for i, t in enumerate(SECRET_TEXTS)]]
    got = QUERIES["op5_secret_scan"](spark, folder(spark, tmp_path, rows)).collect()
    want = []
    for doc_id, text, *_ in rows:
        spans = [(k, a, b) for a, k, b in plain_secrets(text)]
        want.append((str(doc_id), *[sum(s[0] == k for s in spans) for k in range(3)], digest(spans, secrets.KINDS, lambda s: (s[1], s[0]))))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == sorted(want)
    assert len({tuple(w[1:4]) for w in want}) > 3
