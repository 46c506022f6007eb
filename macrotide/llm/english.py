"""English words, most frequent first, as the documentation of Python's libraries uses them (5,280 words)."""

WORDS = tuple("""
the and for this with that returns are from value not return will default object values parameters function data true
name string used can array examples type none column which when list optional spark import all given pyspark class
also index use file series false method number dtype each only input versionadded set one should int using same must
example new specified whether have result into columns bool python instance any path model first may numpy but its
other argument returned then schema has axis names arguments where output args functions elements defaults than you
called format module version order tuple code objects passed see note doctest otherwise create time more two call
exception sequence single field current notes key parameter types message integer ndarray does line case dict
dictionary pandas element length error source sets containing text either check versionchanged supports raises arrays
convert attribute strings was shape there instead like read information rows methods test after they size copy
provided before bytes these both connect multiple pygments expression over directory empty defined details boolean
level float raised table raise such equivalent keyword fields valid contains node between options attributes mode
without characters scalar group files some match support out keys based write def along end option compute different
self item row following base corresponding implementation representation found last character indices supported matrix
uses pass equal original position converted context created label within their maximum target memory deprecated left
start classes header standard user always window available datetime lines make buffer items style idx callable matches
required include been them lexer being process would pattern means binary variable encoding missing sorted operation
cannot get request added labels metadata point range possible representing right specify another generated resulting
part already generate because command mapping results need points calling contain sort iterator apply internal col
parse local second unique change state form server query null through named stream coefficients zero additional date
protocol distribution instances most mask block want warning since reference categories operations connection
copyright just useful underlying while behavior axes except how custom find errors statement dataset timestamp
subclass run system calls special present numbers expected existing remove complex frame work takes directly package
currently event turtle iterable during represents response team minimum times add inputs matching configuration
variables descriptor about allowed removed partition extra every similar numeric invalid tuples negative gets provides
color below offset usage take specific even map full interface could fill count future categorical whose those allows
strategy specifies common computed runtime stored once kwargs per handle including parent access relative width masked
applied allow ordered exists polynomial ignored via integers least root provide headers requests alias vectors unless
necessary ser try written documentation setting lists compatibility unicode way less many view specifying dtypes
regular real parsing dimension widget were entries considered java what filename simple namespace your replace vector
decimal mean exceptions levels weight implement extract split treated against next address decorator precision perform
appropriate back cache cases construct pairs running join creates constructor random needed here checks else content
operator open automatically helper slice environment wrapper sequences timeout display frequency validation product
socket print according place converts timezone nodes associated manager recent console above prefix nested indicates
syntax library dimensions large handler thread until extension side sample days well info section literal plot hook
compatible parsed pyarrow tree passing avoid execution day language however assert sum params bound collection session
ensure graph exist encoded override database references represent build entry interval serialization under validate
hypothesis tensor stack itself generic config pair definition load define location positive token core parser pydantic
conversion contents determine writing pytest features global changed creating rather included indicating record
absolute returning algorithm identifier select executed calculate generator regex sys replaced done update caller
control weights explicitly versions arrow depending engine limit body total own reading greater byte inferred feature
inside now cast store arbitrary computes works condition property temporary long tag loop filter log difference math
still contained domain three messages please scope stop particular etc enable shared actual compare dataframe send old
tests tempfile requires fixture description comparison save exactly around bar windows generates show entire made
positional mark determined yield accepted produce transform pool keep attempt obj abstract accepts evaluate rank
partitions freq flag initial known very expressions performance refer adds ints blocks func modules seconds zone
quantization compression space hash document search might speed basic dates host specification streaming lexers users
typing includes formatted defines subset image year changes closed paths resource implemented digits settings
traceback annotation tags close needs normal main lower enum previous final batch arr properties formatter logic ones
degree logging task groups our unlike proxy styler never subclasses duplicates kind ignore supplied signature counts
installed too requirement applies register raw inverse wrap fit addition url whitespace tokens child step drop exclude
taken category performed execute cause filled indexer fails top month callback evaluated annotations trailing handling
high correct follows rules terms codes aggregate fully small gives bins flags wrapped together indexes requested
registered certain aliases union append desired described separator yields linear across leading makes checking
selection distributions enabled usually various render validator assigned directories related fixed operators
replacement struct having scale evaluation plugin starting effect modify larger private actually client assumed strict
docstring flattened relation later padding indexing parts floating external implements omitted decode records
initialize warnings static ascending intended explicit release platform formats loaded encode structure hermite occurs
internally indicate individual optionally words fail processing insert terminal depends formatting screen conftest
port duplicate status application coefficient represented degrees compressed progress whole models reads smaller
appear timedelta merge variance definitions coordinates starts look parses selected member keywords bin container
repeated component unchanged sent outputs components queue scheme imported appended thus arg program separate handles
serialized produced machine constant clause logger scalars pickle accept testing dataclass foo matplotlib iteration
immediately general outside holds spaces escape correlation low unit forward transformed archive typically remaining
controls height json active suitable threads something timestamps diagonal nothing sorting require places logical
assignment term param skip beginning help max requirements therefore interpreter delete meaning complete wheel
training several highest cached invoked chebyshev runs chunks qualified better occurrence commands matrices checked
bits locale normalized upper compared converting title move floats iterate average singular falcon plugins public
consider vary quantile roots quantize parquet metrics polynomials functionality recursively years modified due
behaviour infer link smallest seed anything patterns suite sign power tied quantized writes exact correctly
implementations reader applying builtin draw lambda verify structured further simply clear double determines rolling
opened lookup broadcast much reset resolve arithmetic word shift multiplication plan inplace recommended operand cat
longer suffix depth bounds dog alternative handled detect delimiter layout merged device copied best corresponds
unknown specifier connections separated evaluates wait matched deviation inner backend combine week overrides policy
regression collections filesystem statistics adding maps mapped samples positions failure factory min resolution saved
boundary styles decoded interpreted lock tolerance period failed descending periods grouping higher calculation
overridden safe creation normally zeros sparse decorated storage printed generating project highlight signal disk
amount derived events summary collected distinct cookies packages previously guaranteed calculated lowest ordering
shrink cursor yet exit possibly writer statements evaluator mammal working round interpolation filling histogram mat
onnx cumulative copies occur compiled members wraps convenience retrieve tasks rule partitioning animal accessed
followed months accessor report descriptors symbol hours observations bird making numerical spec newline semantics
backward service approximate refers generally disable proto faster inserted again basis renderable variant cell
immutable transpose respectively legacy able mixin chunk duration defining updates install give charset square
unsigned threshold frames typed cookie processed outer performs background combination consecutive largest native font
thrown cols disabled repr angle network reverse updated bit constants identical email direction implementing locations
groupby packaging theme destination built globals dictionaries sure discrete builder scipy assume shown dot age hold
metaclass describing marker attention retry mixed initialized conditions ambiguous wrapping substring initializer
extended breakpoint follow addresses prompt nearest providing preserved combined dicts colors zstandard skipna psser
listed removes switch preserve placed decoder pickled grouped resources expanding tensors validators started edge
invoke prints though script normalize dynamic offsets constraints reason profile preferred pipeline midx slices action
comments off often changing unused assumes integral alpha drawn pip trying shows short force reserved embedded mutable
looks accuracy processes inference factor mock deleted fallback extensions readable responsible issue choice origin
equality sends handlers receive occurred printing independent finally obtained received potentially become division
computing pretty literals constructed choices differences validated tries configured upon locals prevent children
occurrences consists exponent filters excluding serialize fitted parrot ref configure free mechanism segments reduced
certificate highlights box complexity loading reshape strictly utility candidate ignoring approach languages quoted
rich markup capture stata trace setup authentication namedtuple mailbox hashable obtain dimensional comment grid
correspond plus neither extracted applicable probably median infinity raising reduce protobuf monkey successfully
subject chosen purposes others computation excluded relevant collect serializer unix indexed down ends excel
themselves fraction distributed area signed transforms doing optimized cells numba skipped sizes bind stable checker
emitted expect guide generation annotated dropped cluster provider debugging likely consistent truncated estimate
increasing channel know hadoop aggregation observation symmetric fourier dependent backwards overwrite plain
probability align nan dependency holding share integration batches inclusive schemas ndarrays nor fast giving
displayed attempts tokenizer kept direct covariance char throw span eigenvalues strategies keeps problem comparing
third good whenever newly marked epoch happens earlier rename priority expensive fewer remote continue debugger tables
captured expand encountered replacing designed undefined buffers encoder master quantiles subsequent operands removing
storing contiguous boundaries page routine turn stdout rest decoding satisfy forms precedence deep template splits
dependencies gap weighted becomes efficient figure taking newlines segment async alternatively sources had choose
hidden intervals overflow identified canvas mouse throws cartesian candidates booleans everything indent chain ranges
notation expects mappings pad virtual meant past prior escaped lowercase replaces retries edges psidx terminated
bitwise failing coroutine especially consumed rounded intersection resolved falls transport duplicated produces
normalization treat pos indicated truncate steps tab rounding padded identifiers datasets interactive rendered four
concrete commit encodes scaled shallow imaginary specifiers building partitioned classification redirect notice
minimal allowing proper enough enables regardless passes predicate quotes things important casting properly lazy
datatype transformation accessing dense executable depend builds hex divide dummy scaling finds differ compressor
selector completed subprocess concatenation coordinate train bias highlighting multidimensional break few tzinfo
percentile population construction fall libraries retrieved distance proxies adjust assertion gateway norm silently
operate referenced decorators datetimes ensures selects recursive dialect visible omit calculating come comparisons
binding barrier assign checkers hints aligned estimator unsupported limited naive inherit appears intermediate onto
attrs catalog algorithms letter track loads constructing slicing region linux indentation yielding getting hostname
aware squares units finite grammar waiting identity insertion shapes hooks leads experimental driver reduction export
propagate initialization systems stops pathname behaves continuous put software expressed constructs converter worker
stage job gradient towards registry going finished writable account looking unspecified physical leave seen comma
inspect keeping documents implicitly fetch easy flow constraint nullable trigger dropna shield clipboard calibration
auth presence automatic platforms executing asynchronous rate really formed hide ctypes identify among percentage
parallel conf evolving trim prepare filtering describe iterables ways introduced password quote dump deprecation
counter iterations scopes symbolic copying affect problems goes concatenated detailed importing expanded instantiate
convenient reported decimals detail lengths filtered purpose delta hierarchical squared filenames moved links latter
additionally utilities sometimes sep streams codec recognized incompatible frozen namespaces milliseconds concatenate
iterating phase performing observed fuse providers fortran fixtures iff effective happen reached optimization strip
alive usual family views scripts joined explanation digit payload failures stores recursion marks unexpected queries
programming button saving leaf converters deg opening portion blank canonical compares attempting turns suppress tools
sampling buffered docs calculations calculates loader subtype transfer showing declared colormap cancelled mypy
conditional calendar did differs inserting hour loss thing yielded fits closest infinite mainly manually stdlib
microseconds instantiating capturing drawing executor prediction lion nonexistent pathlib builtins modification
respective specialized safely alternate representations shell pointer customize modes necessarily interpret causes
emit intercept remainder partial wrong checkpoint validating combining recommend ids plotting fitting degradation
primary keepdims hint registers feed inherited accessible pointing stderr collector fractional attached although clean
dynamically kernel prefixed convention separately restore applications augmented subclassing red backed listener jar
labeled serious swap initializers declaration describes unpack connected similarly compile releases implicit
determining respect schemes docstrings doc decide guess anchor extend signals nonzero instantiated attempted flexible
verbose mostly moving improve managed unbiased horizontal ddof interchange vandermonde searched issues keyed usable
invocation temporarily callbacks appending assuming hierarchy registration markers finding backslash equals
conventions alignment floor executes located older partially deal combinations locally analysis seealso stacked
predict distro discriminator coef defaulting reasons debug supporting ops detected garbage sheet repeat front routines
limits overriding containers puts hence retrieves potential num vertical uppercase scala pearson renamed easier
fragment extras subgraph ready hexadecimal cleanup commonly beyond discarded patch tells enclosing lead layer conn
behave conform approximation bottom overhead preserves stats aggregated prefer sentinel noqa uniques zones prereleases
broadcasting completely act inline uncompressed val stripped hand allocated translated flush sending middle density
estimated spaced percentiles conversions guarantee representable whatever structures blocking sides clusters verbosity
enforce exponential underscore jobs dateutil membership resolver comes permission overwritten caused breaks maintain
belongs managers multiply implies tabs quite inexact retained live customized bases whereas human consumes extracting
displays natural focus selecting stub shuffle exposed products scan reorder summation solution quarter shrinking
classname autosummary readline completion bytecode purely translate primarily symbols major broken adjusted
significant states framework cost runner overlap initializes serializing receives extracts leaves predictions
correspondence lost derivative hermitian trees breakpoints weekday slightly rendering dotted identifying formal enter
frequencies documented coerce freedom compound affected meaningful actions parametrized counting fact animation gather
caching met latest assignments transposed hashes masks truth justify torch equation meta repository ndim press site
cross zip minus blue compiler manner appropriately score leaving bad prepend timer cycle suffixes integrate reports
sorts center jump mismatch gaussian specifically retain primitive sampled expr enabling downloaded vectorized pivot
minutes renders cow loc highlighted spans bundle typical iterates browser owner decompressed dir optimize idea sense
consisting weak ordinal terminate slot bold cosine measured flat cleared cython parentheses threading manage sensitive
learning alter dialog shorter flatten validates attach let nanoseconds enumerate closes wide forces wish await
instantiation decodes exclusive far reused caught minor logistic overlapping consist guarantees avoids invokes merges
escapes finder compact heap branch diff circular finish collecting beta sub sink clustering aggregations sliced
consistency pairwise companion importance optimal ufunc roundoff installation brackets dispatch successful begin slow
ordinary ending exits piece consume helps letters soon multiplied logarithm bug enc colon transformer shortcut
modifying interpretation callers dataclasses elsewhere white convertible reflected divisor viper sidewinder indexers
grouper activation domains remains prefixes unavailable unpacked triples compress thousands distutils issued
evaluating design chars big parsers controlled matter precise decompression naming shall bare inspired parents pixels
corner uniform namedtuples remain notebook randomly cancel bars decomposition clip cobra midnight diagonals symlinks
care encodings var easily unary turned username folder heading odd roughly breaking shifted essentially callables
trimmed processor importlib warn del dist incorrect referred clauses req merging subplots vocabulary buf dogs
formatters codepoint multiplicity asyncio sequential web pack counted instruction gzip indicator complement lib loops
license finalizer ratio minute clears push declarations recorded adapter imports baz anywhere increase init profiler
supposed download producing restriction monotonically splitting undo rational particularly sliding deterministic
transformations stages backoff pytz practice regexp elementwise cond resampling fly analogous repl kwarg activations
transition multipart timezones locator quickly iterated succeeds searching interaction monday shorthand nesting
opposite packed presentation twice preceding considering subtract falling protocols classic rights introspection fresh
pick measurement prepended entirely got almost restrictions acts inserts originally cert modifies delay accordingly
chunksize collects reporting catch reversed answer inf wrappers affects generators resolving expose widths deserialize
serializable dropping lazily refresh rec bear heads caption downcast oneof google invoking entered lineno sessions
hashing january satisfies truncating clients pickling incomplete ranks person percent nonnegative rounds numerically
unbounded near pickles ignores terminates discard nice substrings extends uniquely caches adjacent effects differently
parameterized developers geometry stateful concatenating credentials delegate exported pixel sourcecode compat spinner
perhaps spam history composite ask fileobj tried exceeds repeatedly detects varies signatures non shutdown enclosed
ties evenly kernels improved wants zipfile success adapted half manages databases underscores graphics appearance
singleton chained rightmost targets specifications backport orders resolves bigint plots autoattribute embedding
development foreground defer interfaces covers implied closing tested reasonable looked tell globally released reflect
pure begins who emits codecs sockets unset uniformly glob fractions relationship functools distribute responses
elapsed statistic spacing acceptable fine tracebacks reconstruct prepares persistence buckets alice attr illegal res
backing logged workaround independently ranking statistical acc receiver transforming factorization fix effectively
careful images wikipedia skips succeed untrusted magic constrain appends disables archives sunday drive concurrent
hosts six programs pipe helpers meet predicted proportional sentence modulo inheritance accumulated simultaneously
abbreviation abstraction remember asked advanced lookups directives relies radians tangent repeats indirect unions
chooses aligns receiving sees accumulator executors explode skipping metric country analyzed exponentially frequent
chunked sine aggregating summed algebra upgrade bools york stacking resultant endpoints solved fold wire symmetry
black rewrite flip convolution improvements polars defects suppose registering symlink extraction conforms weeks
identifies say management triggered universal env moment deletion pending smoothing measure paragraph border hard
saves early verification simpler bugs connecting reuse delimited mix relatively accurate functional timeouts abc cover
pyc serializes bucket preserving dedicated binds decision decreasing sharing estimators rabbit mapper preference
residuals spelling onnxruntime concat draws thought strides semantically categoricals equivalence controlling
unpacking tracing opcode tool efficiency detection involved posix unmodified architecture exposes kinds buffering
legal equally transparent lexical searches pseudo avoided triangular sigma recognize placeholder said overview
propagated trusted certificates walks forwarded similarity rejected bytestring consumer prevents linked revision ever
redirected prepared seems profiling conjunction structural printable pruned chaining post configurations teardown
ideally rely approximately unordered ind solve assigning kendall byteorder importable datetimelike egg versus
compliant exporting styling pycon propagating rebuilding warns mocks visibility subdirectories chrome uid insensitive
digest nature walk declare incremental separators incoming huge alone numbered estimates bandwidth bounded linearly
impossible derive sufficient scientific super maxsize initially dest populate maybe increases slots acquired exceed
excludes mutate substitute allocation sections surrounded alphabet behind narrowing quotient operates gamma reach
hardware workers play contrast decorate satisfied combines consumption listening dealing continues eps offers slower
classifier discovery thresholds demonstrating reindex medium spearman resampled dimensionality modern tracking packing
templates parametrization visualization ufuncs linalg hit supply operating summarized displaying belong quoting
preceded locate achieve interpolated occurring curve monotonic explained exhausted powers magnitude reduces simplest
visual fills flavor overall modifications situations guard exited topics drops seem delimiters existence edit marking
redirects covered circle learn demo newer rewritten pid central distinguish launch deserialized projection catalyst
pinned developer reducing quantity inferring atomic cancellation denotes mathematical centers len rectangular recall
scales soft translates holes ffill bfill resample escaping born backtick resampler conflict mimic criteria truthy
wheels pruning preprocessor rcond shifting netloc listlike debugged decides leap decompress temp managing repetitions
pieces contexts suppressed listing tokenize timing permitted opposed unpickling servers cycles locked stdin resets
indented scanner coercion separating exports compiles normalizes afterwards encapsulates bitmap five criterion
variants caution blocked transaction stripping interesting incorrectly urllib english endpoint waits denote restored
structs broadcasted textual stay limitation standalone assigns reflection classmethod infers comparable scatter
regularization multinomial choosing casted tabular orient masking head edition consumers pre folding quantizes icon
underline warned deque why ydeg nopython emoji suggested home prompts slash former exiting lets accesses diagnostic
held subsequently helpful finalizers strftime truncation mail established replacements prepending cut solely express
away efficiently scanned wildcard analyze limitations ast yourself refused scheduled argparse doctests plane turtles
tkinter poly installs communication expired divided uuid braces proposed carries upstream simplified inherits org
invocations exploding logs overwrites plans checkpointed reliable watermark attaches understand eventually fetched
optimizer john ceil confidence plotted trained ensemble individually toy apache workbook cased usecols ret coroutines
folded fusion forced capable patches italic pools roll portions nogil initialise shrinker lot querying disabling
maintained bytearray lacks fastest deleting exceeded fname furthermore installing truncates imply reaches multiples
treatment estimation frozenset apart lies benefit selectors came descriptions machinery verified increment visitor
multiline validity determination substitutions maintains dots complicated bindings pads orientation predicates
activate curly star finishes batching reproduce tracks persist joins subquery initializing cores dispatches stopped
tick nanosecond outermost surrounding mixture decay transformers factors quality correctness animals reindexed
backfill unstack unstacked wrote feather homogeneous penguin batman isna legend somewhat scenarios sdist unequal opset
clock typ memoryview defect transitions analogue renderables security unable updating worth renaming stuff seek
lifetime opens malformed ensuring topic texts frequently substituted triple subclassed descendants permissions seq
extremely mutated recognised fashion discovered notified alert visit effort dividing presented technique directive
little unittest recording toplevel closure concept narrowed killed risk question datatypes coming destroy eager nulls
asof online gathered anymore mutually jupyter differentiate artifacts pie rmtree rating formula activated allocate
urls multi ultimately logically safari swapped verifying squeezed interpolate groupings fig specialization university
mirrors ellipsis pyproject unrecognized fragments diffusion gelu quant atom rebuild refs footer trivial retrieving
titles argsort pearu peterson interest derivatives downloads nicer nodeid daylight zoneinfo virtualenv mentioned
browsers stopping quiet compilation captures longest tail basically reachable proceeds environments destroyed
microsecond coverage outfile translation meets causing situation enhanced coerced noise exp verifies greatest fused
blockwise superclass timed equivalently simplify accumulate submodules establish stands accepting notable unbound
statically backslashes ascii cloned guessed persistent snapshot extending think conflicts arbitrarily contrary
leftmost examine outcome supplying returncode closely enforced octal instructions respects hive api natively
unnecessary datasource ability checkpointing ordinals unpivot probabilities collation eval termination idle regarding
shutil gain forming dataflow generalized putting achieved skew batmobile backends alphanumeric price folds stale
exclusion reject refuse appeared preprocess fed light terminals parametrize populated traversable expecting editable
jitted isolated pointed says centered emulate collapse increased customization subtraction memo writers goal gaps
official interactively acquire descendant absent aspects expansion commas ceiling rotation conflicting overload
localhost traverse conjugate immediate counterpart sleep shut upload late vendor fairly abbreviations indirectly
notion contextual treats moves approximated annotate chance encryption setuptools udf repeating restarts persists
carry nullability deduplicate introspect collectors casts interrupted inlined inject interoperability concatenates
trust parallelism recreate multiclass forest divisible discover significantly bee reindexing sparsify viewing reshaped
squeeze surprising ticks residual allowable pretrained conv externally assembly superset business stylesheet
integrated triplet verbatim accounting principle syntactic utc eigenvalue rtol ctype recarray entity tracker linesep
alphabetically unrelated prepends flushes slowest enters constructors omitting narrow readers manual assumption
conforming const primitives unregister inspecting satisfying denominator standardized deeply possibility people
losslessly developed vice unwrap completes serve resize pressing elif enumeration introduce alternatives restart
interact composed nonempty startup redundant overloads capitalized recurse customizing launched setter discussion
planning dataframes ahead ambiguity denoted concurrently obtaining identically varying git isotonic bisecting
recompute requesting unmapped discards downsample upsample multiindex latex performant sheets squeezing relying
untouched timedeltas shrunk reordered dark solver traditional permit aka shim shrinks auto contrib net producer
bundles replay err unsafe restricted pascal boldface adapters technically considers flushing shaped inaccurate
discussed robust obsolete integrating timeseries notna invariants phrase inspected unaffected queried funcname deletes
green altered aliasing normalizing knowledge knows traces entering invariant eggs writeable pickler misc variations
scanning wildcards averaged proportion targeted fullname underflow removal retrieval internals fixes maintaining
subtracting submodule grow bodies matters unambiguous obvious referring traversing chains continuation capabilities
ciphers mimics grab unhandled happened daemon heterogeneous encrypted bunch recently allocations deals pull aliased
unified pictures rotate bounding specially introduces cleaning clearing course flattens localns affecting unstable
identities checkpoints lit projects mismatched concise windowing unpickled policies mutating sequentially suffixed
kurtosis presents correlations subplot wishes paper epsilon orthogonal fillna ewm generalization skiprows succeeded
clocks involving preferences devices alongside reducer zipped unlikely autodetected contributes flushed disallowed
stride preparation highlighter javascript fonts forbid syntactically impact subtypes exposing itemsize deficient repo
ini subok weighting spline hist transmission varint entities abbreviating guides unquoted overlapped curses stat
subdirectory encounters pages hashlib despite considerably deferred manipulation eliminating slashes manipulate
asynchronously interested dead informational intent unconditionally echo predefined greedy reload relations scores
sized selections punctuation whitespaces besides mixing sin opaque exclusively advantage proceed finders inspection
mirror promise suspended duck tagged authors intention engines reentrant joining initialised heavily resume secure
regexes abbreviated julian confusion filepath possibilities worst confusing interacting ran catching suites shebang
movement vertically literally desirable spent tricky lose picklable incremented quotation globalns analyzing narrower
wider responsibility lack favor services nicely accessors serializers scenario hides separates explain desc variation
compose unmatched nondeterministic strongly signifies respected flexibility retried instruct mismatches unescaped tip
latent outcomes principal treating isnan configs innermost thanks deduced bat belonging styled denoting nrows
delegates cumsum roundtrip rewriting dayfirst yearfirst objective layers difficult lambdas reconstructed linking snap
logits subgraphs tracked bypassed doctype adapt editor grey templating scripting notification music paste reasonably
foreign django namely holder disallow understood collisions vendored auxiliary ideal notably deprecate promotion wall
equations inversion conditionally broadcastable argname subarrays reductions corners pol albeit quadrature fftshift
phases subtest dirty savings numexpr fastpath subparts inclusion fork strips saturation race forth oldest summarize
anyway patched east endings translating detached advance unlock restores subtle quotechar geometric variability spread
reciprocal ratios measures hyphens stricter closer engineering swaps unaltered inverted rotated serves quick
classmethods powerful blanks crash dumped wanted ownership internet scheduling securely intrinsic yes substitution
shortest retains extent ext fancy beautiful maximal likewise versa friendly configurable pressed consequently clone
inheriting synonym annotating generics trick overloaded multiprocessing branches disclaimer pushed exploded iterative
repartition existed triggers aggregates deduplication semantic hello world unnamed paired parity thereof transparently
deserialization parallelize outliers tuesday comparator absence iteratively euclidean multivariate flows successive
netcat pser firefox alternately alfred caveats horse com alphabetic tutorial prod specialised arise solving picked
recommendation assemble interactions workflow fingerprint specs touch synthetic stays scoped regions categorize
optimizations downstream schedule fake entropy contract dims straightforward distinction ancestor vim academic ruby
contributed unfortunately theory ansi intentional httplib tunnel amt discarding snake sibling requiring fsspec
endianness reversing illustration cambridge minimizes whichever astype der rid downloading suspend datelike setitem
videos loaders awaited scrollbar bootstrap precedes konqueror european essential mtime someone finalization
lightweight pydoc rewind associate owned contribute programmatically placing whence connects dictates remembers locks
dialects adhere popped walking ranked midpoint opts unnecessarily violated invert indication forbidden mechanisms
executions irrelevant interspersed undone pop triggering getattr sole authenticate handshake synchronization owns
incrementing pow promote sender hack substituting anonymous procedure separation reordering referencing deltas unusual
parenthesis tup stamp reflects boilerplate miscellaneous aims unreachable synchronous datagram inappropriate mandatory
mod rejects decided projected cleaned util redistributions commutative minimize subtracted precisely deletions
demonstrates needing interrupt millisecond injected localized skewness saturday interprets flattening scans growth
migration subsets solves distances materialized contributions enhance enumerated preamble multirow descriptive
prescribed involves march easiest boxed protected figsize consideration subarray poorly tol enums typevars pickleable
app carefully dev canonicalized clipped carrying enforces octets codepoints emitting benchmarking latency lives shares
processors verb reside resides frameworks colorful emacs macros decisions debian installations paging monospace margin
pooled fetching clashes concern qualifier monkeypatch solutions mutation discouraged ravel tensordot endian radix
lexsort resized editing straight manipulating maxpower differentiated differentiation vander unsquared interpolating
tends overlaps inequality explanations duplex battery declaring excinfo assertions historical instant lexsorted
accumulation hood publish redirection normalised desktop instants subtree rewrites delegated handy shot pathnames
collapsed functionally resumes archs makefile channels positioned abs derives consult distinguishes seeking bufsize
draft eliminate numbering recover monitor localization plural redefine suit preferably badly tie overwriting baseline
snippet inconsistent cleans consuming sanity expires arrange abort restrict strptime cipher minimizing examined
decrement identification divmod topological expands scheduler protection getter deeper highly subsequence originating
popular isolate jumps behaviors intact basename bypass modeled book revised correction hiding beware familiar
circumstances subprocesses obey dispatched completions confuse absolutely offer ease nearly periodic arrives planned
replicated tiny finalizes sphinx sorter replicate encouraged dumps reloaded throwing manipulated exprs cloud
invalidate skewed life materializing equivalents backs univariate adopts labeling boxplot encourage boosted
mathematics computational stacklevel zoo pasted approx wherever vals temperatures amounts aggfunc reproducibility
machines worse panel daily february reaching advisable expresses covering assembled configures improvement readonly
streamed respond chardet usages mess intersect finalize testsetup abstracts dashes influences threaded agree offered
forwards offending adjusts dim bert longformer whisper rearrange compliance preprocessing perl hyperlinks asserts
manifest tokenizers validations repetition great inverts bundled accommodate uint preferable promoted searchsorted
uninitialized calculus monic spurious clenshaw worked shifts boot unify facilitate friends unhashable uniqueness opt
budget decoders upcast standards arraylike pin told refuses transient fuzzing expat backup filesystems mozilla
resembles silence reraised originate defers unpredictable strong mount collapsing zeroes contributors terminating
advancing transmit violation quit lots escapechar probable wins resp syntaxes onwards emulates idempotent speeds
graphical reproducible sync ought signs losing silent checksum thin staticmethods miss explaining switches confused
somewhere involve unwrapping alters readability capacity activity cyclic driven toggle blocksize earliest fourth sums
quadratic author pulls anchors precede alternating protect introducing turning encounter canceled accelerate observe
adapts interior horizontally prime routed exec comprehensive decremented aborted spawn undocumented completing
sophisticated designated intentionally expectation costly kenneth avoiding successively locating entrypoints blob
cogrouped configuring restarting udtf placement demonstrate city asks periodically lifecycle throughout intends
conceptually advised ended illustrates materialize polar unparsable reflecting quartiles reliably bootstrapping
softmax piecewise vertex intuitively ancestors conventional scratch isin meaningless issuing advice illustrate
positionally organized clarify sensitivity truly objs stick sharex sharey builders practical maximize peer initiated
notebooks unlimited additions latin perfect indirection autodetect prerequisite encountering historically
bidirectional recognizes graphs embeddings layouts production feeding adjustments palette rare thinks suggest
differentiating shadow borders critical somehow borrowed provisional carriage respecting weakref polymorphic rebuilt
vars discriminated motivation indeed coercing looping unpacks mocking smarter overly sugar restoring deactivate
currentmodule precisions couple amax amin teukolsky flannery broadcasts void occupied sticky infs typecode
accumulations argmin argmax fixing unmanageable zdeg instability unscaled pierre consequence relaxed noting nans
everywhere availability rarely facilities ported entrypoint unquote accidentally faithfully imposed myself hashed
unquoting sortedcontainers uninstall lowercased noticeable interpreting recreated facility directs unbuffered
incorporated searchable deduplicated sortable partly differing architectures patching settable selectively
counterparts unusable simultaneous adjustment meanings switched summing accurately superclasses snippets extensible
underlined freed exhaustive solaris unwrapped fair preparing decreases arranges deadlock toward tolist enqueue sans
demand pops mounted catches intuitive vulnerable pointless logo imagine stretched toolkit oriented became numerator
delegating reassign encapsulate injection frozensets capitalize permutation diagram synchronously undetermined
simplicity finalized forcing exchange outputting redistribution informs prefetch replayed continuously stated
correlated ages refreshes cardinality regenerated purge statuses apple durations regarded increments theta visually
quartile submitted incrementally maintenance contribution robert appearing multiplying empirical regressor led nunique
defaultdict lag backticks cumprod orc substantially medians ephemeral counters granted unsatisfiable exploring abi
flips grows batched boxes guidance encoders runtimes enumerates targeting considerations feeds happening effectiveness
clipping deliberately regenerate linewise guessing installable surrogate bright colours indicators shorten packs
commandline prototype recipes claims hope posting clash preloaded isolation iterators inefficient undesirable simulate
relationships party coercible room cleaner negated marginally subpackage codebase speaking permute environmental
viewed lie bracket decorating conditioned splines resemble overdetermined neglected unintuitive problematic beforehand
accounts hexbin lexicographical undoes memoize refactoring placeholders secondary predictable permanent solid lossless
intelligently refactored uri deemed consistently agent licensed uninstallation signify dumb directed launching visited
renames populates worry eight randomized portable interfere detecting intermediary summaries stating concerned
shortened poor disagree hits heuristic reveal disappeared authorization stateless asking binned simplifies capability
convergence divides introduction published improves annoying unambiguously delivered rough subsystem examining
sensible seven pythonic capath fillvalue tuning formerly enqueued reimplementation lang jython deepcopy tend claim
craft insufficient facing feedback computations ring erroneously leak noted spell impose unsound hypothetical
simplifications randomness forked gracefully editors introspected retaining tooling interacts shuffled materials
motivated overflows integrates eagerly forget unparsed analyzes multiplier packaged utils recurses locates missed
vanilla circles graphically flatmap proceedings international papers terminology affinity preexisting nones downgrade
consecutively splice dispersion replicating cummin cummax startrow startcol bottommost compressors mass comprise
article proportions unwanted flaky ourselves uncommon propagates began freely inherently embed timesteps intend
siblings matmul unclear filetype analyse prettify colored lookahead disambiguate hopefully computer obviously
filetuple nonamefile pythons drains urlopen establishes leaked colons aforementioned shortcuts serving barthelemy
redis conformance seeing benefits feel mutations contextmanager isinstance loose spelled supplies majority aid
preventing perfectly traversed comply keyboard mistake severe lexically colno quirks annual dayofweek unsuccessful
chunking totally fullmatch cancelling reitz certifi unpinned hereby charge sublicense sell persons whom furnished
substantial explore spit unformatted pause vinay sajip
""".split())
