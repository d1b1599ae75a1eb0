"""Import every query module so the registry is complete."""

from . import q_indicator  # noqa: F401
from . import q_episodes  # noqa: F401
from . import q_depr  # noqa: F401
from . import q_qa  # noqa: F401
from . import q_ingest  # noqa: F401
from . import q_attr  # noqa: F401
from . import q_flows  # noqa: F401
from . import q_geography  # noqa: F401
