"""Schemas of parsed mails."""

from __future__ import annotations

ATTACHMENT = "struct<filename:string,content_type:string,hash:string,data_base64:string>"
PARSED = f"email_id string, header_list string, raw_headers string, body string, og_fname string, attachments array<{ATTACHMENT}>, label string, _parse_error string"
