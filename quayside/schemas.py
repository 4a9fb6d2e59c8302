"""Row types of the landing zone."""

LISTING = "path string, mtime timestamp, length long"
RESOURCE = "bid string, name string, url string, content_type string, status_code int, derived_from string, content binary"
REQUEST_META = "url string, depth int, referer string, headers map<string,string>, flags map<string,boolean>"
STATE = "k string, v string, put_at timestamp, expires_at timestamp"
REQUEST = "source string, day date, prefix string, cursor string, url string, max_records int"

_UNIT = (
    "siren string, statutDiffusionUniteLegale string, dateCreationUniteLegale string, denominationUniteLegale string,"
    " categorieJuridiqueUniteLegale string, activitePrincipaleUniteLegale string, trancheEffectifsUniteLegale string,"
    " effectifMinUniteLegale int, effectifMaxUniteLegale int, dateDernierTraitementUniteLegale string"
)
_SITE = "siren string, siret string, dateCreationEtablissement string, codePostalEtablissement string, libelleCommuneEtablissement string"
#: An API page; the cursor may stand in the header or beside it, counts likewise.
PAGE = (
    "header struct<statut:int,message:string,total:long,debut:long,nombre:long,curseurSuivant:string>,"
    f" unitesLegales array<struct<{_UNIT.replace(' string', ':string').replace(' int', ':int')},"
    f"etablissements:array<struct<{_SITE.replace(' string', ':string')}>>>>,"
    " total long, nombre long, curseurSuivant string"
)

#: Default times to live, in seconds, by kind of state.
DEFAULT_TTL = {
    "processed": 7 * 86400,
    "state": 7 * 86400,
    "results": 30 * 86400,
    "errors": 86400,
    "counters": 30 * 86400,
    "timings": 7 * 86400,
    "session": 86400,
}
