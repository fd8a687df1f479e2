"""Import every query module so the registry is complete."""

from godown.plans import queries  # noqa: F401
from godown.plans import queries_more  # noqa: F401
from godown.plans import queries_checks  # noqa: F401
from godown.plans import queries_model  # noqa: F401
from godown.plans import queries_dash  # noqa: F401
from godown.plans import queries_io  # noqa: F401
from godown.plans import queries_sparse  # noqa: F401
from godown.plans import queries_asof  # noqa: F401
