"""Every query of the subpackage, with its SQL where there is one."""

from tillgrain.llm import (  # noqa: F401
    bpe, conversations, decontaminate, html_text, jaccard, licenses, maxscore, pivots, quality,
    sharding, tiles, toxicity, warc,
)
from tillgrain.llm.tables import ORACLES, QUERIES  # noqa: F401
