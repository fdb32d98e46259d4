"""ordo: sort and check very large ``NUMBER. TEXT`` line files with Spark.

Lines are parsed into ``number, text, line``; malformed lines are set aside
with a reason; the rest is sorted by text (ordinal), then number, then line,
as DataFrame transformations, so Spark does the partitioning, shuffling,
spilling and committing.
"""

from ordo.operators import *  # noqa: F401,F403
from ordo.plans import *  # noqa: F401,F403
from ordo.session import local_session, shared_dir
from ordo.sources import *  # noqa: F401,F403

__version__ = "0.1.0"
