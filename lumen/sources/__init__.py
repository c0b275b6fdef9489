from lumen.sources.export import write_ordered_text  # noqa: F401
from lumen.sources.tables import TABLES, load  # noqa: F401
