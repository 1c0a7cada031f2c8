from .vcf_text import (VcfHeader, body_lines, parse_header_lines, read_header,  # noqa: F401
                       read_lines, resolve_source)
