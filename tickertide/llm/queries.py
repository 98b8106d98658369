"""All queries of this subpackage."""

from tickertide.llm import q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13  # noqa: F401
from tickertide.llm.registry import ORACLES, QUERIES  # noqa: F401
