"""Named queries over the star-schema tables, each with its SQL check where SQL can say it."""

from dockline.plans import feeds, models, pages, questions, sqlfunctions, stations, streams, trips  # noqa: F401
from dockline.plans.registry import ORACLES, QUERIES  # noqa: F401
