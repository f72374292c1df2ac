"""Upload of files to an object store behind a small HTTP interface.

A file is announced at /upload/init, its bytes go to the addresses given
there, and /upload/confirm makes it a file of the store. Large files go up in
parts, which /upload/complete-multipart puts together.
"""

from __future__ import annotations

import secrets
from pathlib import Path

from folioflow.functions.text import MEDIA_TYPES


def media_type(path: str | Path) -> str:
    return MEDIA_TYPES.get(Path(path).suffix.lower(), "application/octet-stream")


def visitor_token(folder: str | Path) -> str:
    """A token kept in the folder; made once."""
    file = Path(folder) / ".visitor"
    if file.exists() and (token := file.read_text().strip()):
        return token
    file.parent.mkdir(parents=True, exist_ok=True)
    token = "folioflow-" + secrets.token_hex(16)
    file.write_text(token)
    return token


class Storage:
    """Client of the store. A bearer token goes before a visitor token; an HTTP error or success=false raises."""

    def __init__(self, base_url: str, bearer: str = "", visitor: str = "", session=None, timeout: int = 120, ca_bundle: str = ""):
        if session is None:
            import requests

            session = requests.Session()
            if ca_bundle:
                session.verify = ca_bundle
        self.base, self.bearer, self.visitor, self.http, self.timeout = base_url.rstrip("/"), bearer, visitor, session, timeout

    def headers(self) -> dict[str, str]:
        if self.bearer:
            return {"Authorization": f"Bearer {self.bearer}"}
        return {"X-Visitor-Token": self.visitor} if self.visitor else {}

    def post(self, path: str, body: dict) -> dict:
        answer = self.http.post(self.base + path, json=body, headers=self.headers(), timeout=self.timeout)
        try:
            said = answer.json()
        except ValueError:
            said = {"success": False}
        if answer.status_code >= 400 or said.get("success") is False:
            raise RuntimeError(f"{path} was answered by {answer.status_code}: {said}")
        return said

    def health(self) -> bool:
        """Whether the store says that it is well."""
        try:
            answer = self.http.get(f"{self.base}/health", headers=self.headers(), timeout=self.timeout)
            return answer.status_code < 400 and answer.json().get("status") == "ok"
        except Exception:
            return False

    def create_collection(self, files: int | None = None) -> dict:
        """The new collection: its id and url."""
        return self.post("/collection", {} if files is None else {"expected_file_count": files})["collection"]

    def upload(self, path: str | Path, collection: str | None = None) -> dict:
        """The uploaded file as the store names it: its id and url."""
        file = Path(path)
        about = {"filename": file.name, "content_type": media_type(file), "size": file.stat().st_size}
        plan = self.post("/upload/init", about)
        if plan.get("type") == "multipart":
            self._send_parts(file, plan)
        else:
            given = {k: v[0] if isinstance(v, list) else v for k, v in (plan.get("headers") or {}).items()}
            self._send(plan["upload_url"], file.read_bytes(), {"Content-Type": about["content_type"], **given})
        return self.post("/upload/confirm", {**about, "r2_key": plan["r2_key"], **({"collection_id": collection} if collection else {})})["file"]

    def _send_parts(self, file: Path, plan: dict) -> None:
        urls = {int(n): url for n, url in (plan.get("initial_urls") or {}).items()}
        sent = []
        with file.open("rb") as f:
            for n in range(1, plan["total_parts"] + 1):
                if n not in urls:
                    more = self.post("/upload/parts", {"upload_id": plan["upload_id"], "part_numbers": [n]})
                    urls |= {int(p["partNumber"]): p["url"] for p in more["part_urls"]}
                sent.append({"partNumber": n, "etag": self._send(urls[n], f.read(plan["part_size"]), {})})
        self.post("/upload/complete-multipart", {"upload_id": plan["upload_id"], "parts": sent})

    def _send(self, url: str, data: bytes, headers: dict[str, str]) -> str:
        answer = self.http.put(url, data=data, headers=headers, timeout=self.timeout)
        if answer.status_code >= 400:
            raise RuntimeError(f"upload was answered by {answer.status_code}")
        return answer.headers.get("ETag", "")
