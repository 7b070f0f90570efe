"""Options and fixed values of the audit dataflow.

Values under "fixed values" must equal the original system's literals for the
results to match; they are stated plainly and in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must match the original system's literals)
# ---------------------------------------------------------------------------
ERROR_NO_FOLIO = "ERROR_SIN_FOLIO"
ERROR_ILLEGIBLE = "ERROR_DOCUMENTO_ILEGIBLE"
ERROR_BAD_FORMAT = "ERROR_FORMATO_INVALIDO"
ERROR_ASSEMBLY = "ERROR_ENSAMBLAJE"
ERROR_EMPTY_ROUTE = "ERROR_RUTA_VACIA"
NOT_DETECTED = "NO DETECTADO"
NOT_IDENTIFIED = "No identificado"
NOT_IDENTIFIED_FOLDER = "No_identificado"
CURRENCY_DEFAULT = "NO_DETECTADA"
UNKNOWN_ORIGIN = "DESCONOCIDO"
STATUS_OK = "OK"
STATUS_REVIEW = "REVISIÓN MANUAL"
STATUS_PENDING = "PENDIENTE"
RECONCILIATION_DEFAULT = "PENDIENTE"
OK_THRESHOLD = 80  # OK when confidence > 80

ORPHAN_CATEGORY_ITEM = "Página Huérfana"
ORPHAN_CATEGORY_RESULT = "Revisión Manual Requerida"
ORPHAN_FOLDER = "Revision_Manual_Requerida"
ORPHAN_PREFIX = "HUERFANO_"
ORPHAN_REASON = "Fragmento excluido por la inferencia."
FALLBACK_REASON = "Fallo de estructuración del pipeline."
ASSEMBLY_FAILURE_PREFIX = "Fallo sistema de archivos: "
PATH_GUARD_MESSAGE = "Ruta de destino contiene caracteres de navegación no permitidos: "

IMAGE_ORIGIN = "LOTE_FOTOGRAFICO_CONSOLIDADO"
ORIGIN_TYPE_PDF = "PDF"
ORIGIN_TYPE_IMAGES = "IMÁGENES MIXTAS"

ACTION_NEW = "NUEVO"
ACTION_OVERWRITE = "SOBRESCRIBIR"
ACTION_DISCARD = "DESCARTAR"
ACTION_VERSION = "VERSIONAR"

ROLES = ["INICIO", "INTERMEDIA", "CIERRE", "UNICA", "HUERFANA"]
ROTATIONS = [0, 90, 180, 270]

ALLOWED_EXTENSIONS = [".pdf", ".jpg", ".jpeg", ".png"]
IGNORED_PREFIXES = ["__MACOSX", ".", "~"]
JUNK_EXTENSIONS = [".db", ".ini", ".ds_store"]
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png"]

CATEGORIES = [
    "Factura", "Remisión", "Devolución de ventas", "Devolución de compras",
    "Recepción de mercancía", "Pedido", "Compra", "Orden de compra",
    "Diarios de ventas", "Ticket", "Recibo", "Otro",
]
PREFIX_SEEDS = [("A", "Factura"), ("P", "Factura"), ("R", "Remisión"), ("O", "Orden de compra")]

# Generic header / footer anchor phrases of the role rules (company-specific
# anchors such as names and tax ids are left to the caller's options).
HEADER_ANCHORS = ["FACTURA", "Folio", "Cliente"]
FOOTER_ANCHORS = ["Cadena original del complemento", "Sello digital", "Total(MXN)"]

REPORT_COLUMNS = [
    "Folio", "Categoría", "Cliente", "Archivo Original", "Tipo Original",
    "Páginas Original", "Páginas Final", "Status", "Confianza",
    "Ruta del Archivo", "Justificación",
]
REPORT_TIMEZONE = "America/Monterrey"
REPORT_NAME_PREFIX = "Auditoria_Integridad_"

CONTEXT_DIGEST_HEADER = "=== CONTEXTO HISTÓRICO Y REGLAS DE NEGOCIO ==="
CONTEXT_DIGEST_INTRO = ("Aplica OBLIGATORIAMENTE las siguientes deducciones basadas en el "
                        "historial del sistema:")
CONTEXT_DIGEST_PREFIX_TITLE = "\nPATRONES DE FOLIO ESTRICTOS (PRIORIDAD ALTA):"
CONTEXT_DIGEST_PREFIX_LINE = ("  - Si el folio extraído inicia con la letra '{p}' (Ej: {ex}), es "
                              "ESTRICTAMENTE un(a) '{t}'. Usa esta regla si la palabra del "
                              "documento es borrosa o ilegible.")
CONTEXT_DIGEST_CLIENT_TITLE = "\nCLIENTES RECURRENTES:"
CONTEXT_DIGEST_FOOTER = "=== FIN DEL CONTEXTO ==="
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class AuditOptions:
    """Tunable limits of the dataflow (defaults are the original's)."""

    max_retries: int = 3
    api_delay: float = 0.5
    vision_batch_size: int = 15
    pdf_chunk_max_pages: int = 100
    physical_chunk_size: int = 50
    burst_gap_seconds: float = 3.0
    top_clients: int = 15
    prefix_examples: int = 3
    recent_documents: int = 20
    categories: tuple = field(default_factory=lambda: tuple(CATEGORIES))

    def __post_init__(self):
        if self.pdf_chunk_max_pages < 10:
            raise ValueError("pdf_chunk_max_pages must be >= 10")
        for name in ("max_retries", "vision_batch_size", "physical_chunk_size"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be >= 1")
        if self.api_delay < 0.1:
            raise ValueError("api_delay must be >= 0.1")


DEFAULTS = AuditOptions()
