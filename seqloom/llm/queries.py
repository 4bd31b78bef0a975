"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import filtering_lloyd, lattice
from .decontaminate import op2_decontamination
from .filtering_lloyd import op12_vector_codes
from .fingerprints import op4_fingerprints
from .language_id import op1_language_id
from .lattice import op11_vector_links
from .mixing import op3_mixing
from .order_minhash import op7_near_duplicates
from .quality import op8_quality_classifier
from .secrets import op5_secrets
from .token_ids import op9_token_ids
from .toxicity import op10_toxicity
from .warc import op6_warc

QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_mixing, op4_fingerprints, op5_secrets, op6_warc, op7_near_duplicates, op8_quality_classifier, op9_token_ids, op10_toxicity, op11_vector_links, op12_vector_codes)}

ORACLES: dict[str, str] = {
    "op11_vector_links": lattice.ORACLE,
    "op12_vector_codes": filtering_lloyd.oracle(),
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        q AS (SELECT page_id, body, octet_length(encode(body))::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS holder FROM p),
        r AS (SELECT *, payload_bytes >= 1000 AND page_id <> holder AS again FROM q)
        SELECT page_id, payload_bytes, sha1(body) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN holder END AS refers_to, true AS intact FROM r""",
}
