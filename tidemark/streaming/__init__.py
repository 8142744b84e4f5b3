from .streams import *  # noqa: F401,F403
