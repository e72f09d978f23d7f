from tessera.operators.pyast import parse


def test_router_prefixes_django_constants_docs_and_cases():
    rows = parse(
        "'Doc.'\nfrom x import APIRouter\na = APIRouter(prefix='/a')\nb: object = flask.Blueprint('b', url_prefix='/b/')\n"
        "@a.get('/x')\ndef f(): pass\n@b.route('/')\ndef g(): pass\n@c.get('/x')\ndef h(): pass\n"
        "urlpatterns = [path('users/', views.users), re_path('/^y$', V.as_view())]\nLIMIT = 3\nmatch q:\n    case 1:\n        def k(): pass\n"
    )
    assert [(r[1], r[2], r[5]) for r in rows if r[0] == "route"] == [("/a/x", "f", "GET"), ("/b", "g", "GET"), ("/x", "h", "GET"), ("/users/", "views.users", "*"), ("/^y$", "V.as_view()", "*")]
    assert ("constant", "LIMIT", "", 12, 12, "3") in rows and ("doc", "", "", 1, 1, "Doc.") in rows
    assert ("function", "k", "", 15, 15, "def k()") in rows
